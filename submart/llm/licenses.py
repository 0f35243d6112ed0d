"""License scans with a generalised suffix automaton of licence words.

The automaton holds all templates and phrases.  A document's words stream
through it once and give the matching statistics: at each word, the longest
run of words ending there that some template contains.  Long runs are chained
per template, in the order of both texts, into covered template spans; a
template covered to ``min_cover`` adds its label.  A phrase's places are the
words where the phrase is a suffix of the current run.

A null or empty text has no words, places, spans or labels.  Repeated rows
give repeated results; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import words_of

#: fixed values: phrases whose places count, with their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: fixed values: words of public licence notices, with their labels
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under the creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nc-4.0", "this work is licensed under the creative commons attribution noncommercial 4 0 international "
                     "license"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

SCAN = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, spans array<struct<label:string,first:int,last:int,cover:double>>")


class SuffixAutomaton:
    """A suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.end: list[tuple[int, int]] = [(-1, -1)]       # a place where the state's strings end
        for which, words in enumerate(sequences):
            last = 0
            for at, w in enumerate(words):
                last = self._add(last, w, (which, at))

    def _state(self, length: int, link: int, to: dict[int, int], end: tuple[int, int]) -> int:
        self.next.append(to)
        self.link.append(link)
        self.length.append(length)
        self.end.append(end)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of ``q`` for the strings that come through ``p``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), self.end[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _add(self, last: int, w: int, end: tuple[int, int]) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0, {}, end)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new


class LicenseScanner:
    """Phrases and templates in one automaton; built once per Python worker."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]], min_run: int, min_cover: float):
        self.min_run, self.min_cover = min_run, min_cover
        texts = [t for _, t in templates] + list(phrases)
        words = [words_of(t) for t in texts]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in words for w in t}))}
        sequences = [[self.ids[w] for w in t] for t in words]
        self.sam = SuffixAutomaton(sequences)
        self.templates = [(label, len(sequences[i])) for i, (label, _) in enumerate(templates)]
        self.sequences = sequences
        # the phrases that end wherever a state (or a state it links to) ends
        at: dict[int, list[tuple[str, int]]] = {}
        for (phrase, label), seq in zip(phrases.items(), sequences[len(templates):]):
            state = 0
            for w in seq:
                state = self.sam.next[state][w]
            at.setdefault(state, []).append((label, len(seq)))
        self.phrases_at: list[list[tuple[str, int]]] = []
        for state in range(len(self.sam.next)):
            found, s = [], state
            while s > 0:
                found += at.get(s, [])
                s = self.sam.link[s]
            self.phrases_at.append(found)

    def scan(self, text: str | None):
        words = words_of(text)
        nexts, link, length, phrases_at = self.sam.next, self.sam.link, self.sam.length, self.phrases_at
        state = run = 0
        places: list[tuple[int, str]] = []
        runs: list[tuple[int, int, int]] = []            # last word, words, state of maximal long runs
        min_run = self.min_run
        for i, w in enumerate(map(self.ids.get, words)):
            before, held = run, state
            if w is None:
                state = run = 0
            else:
                while state and w not in nexts[state]:
                    state = link[state]
                    run = length[state]
                if w in nexts[state]:
                    state = nexts[state][w]
                    run += 1
                for label, n in phrases_at[state]:
                    if run >= n:
                        places.append((i - n + 1, label))
            if before >= min_run and run <= before:
                runs.append((i - 1, before, held))
        if run >= min_run:
            runs.append((len(words) - 1, run, state))
        spans = self._chains(runs, words) if runs else []
        base = sorted({label for _, label in places})
        labels = sorted({*base, *(s[0] for s in spans)})
        starts = [at for at, _ in places]
        score = max([s[3] for s in spans], default=0.5 if base else 0.0)
        return (len(words), len(places), min(starts, default=None), max(starts, default=None), base, labels,
                score, spans)

    def _chains(self, runs, words):
        """Per template: its runs chained in the order of both texts, kept when they cover enough."""
        out = []
        for which, (label, size) in enumerate(self.templates):
            seq = self.sequences[which]
            best: list[tuple[int, int, int, int]] = []   # covered, first word, last word, end in the template
            for last, n, _ in runs:
                part = [self.ids[w] for w in words[last - n + 1:last + 1]]
                # the longest suffix of the run that the template holds, and where
                for m in range(n, self.min_run - 1, -1):
                    tail = part[n - m:]
                    starts = [s for s in range(size - m + 1) if seq[s:s + m] == tail]
                    if starts:
                        break
                else:
                    continue
                s, first = starts[0], last - m + 1
                link = max((b for b in best if b[3] <= s and b[2] < first and first - b[2] <= 2 * size),
                           default=(0, first, 0, 0))
                best.append((link[0] + m, link[1], last, s + m))
            for covered, first, last, _ in best:
                if covered >= self.min_cover * size:
                    out.append((label, first, last, covered / size))
        # the best chain per label and place
        top: dict[tuple[str, int], tuple[str, int, int, float]] = {}
        for s in out:
            if s[3] > top.get(s[:2], s[:3] + (0.0,))[3]:
                top[s[:2]] = s
        return [top[k] for k in sorted(top)]


def scan_licenses(docs: DataFrame, text_col: str = "text", phrases: dict[str, str] | None = None,
                  templates: list[tuple[str, str]] | None = None, min_run: int = 3,
                  min_cover: float = 0.8) -> DataFrame:
    """``docs`` with ``scan``: words, phrase places, labels, score and template spans."""
    args = (phrases or PHRASES, templates or TEMPLATES, min_run, min_cover)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    @F.pandas_udf(SCAN)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = LicenseScanner(*args)
        for texts in batches:
            out = pd.DataFrame([tool.scan(t) for t in texts], columns=columns)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn("scan", scan(F.col(text_col)))
