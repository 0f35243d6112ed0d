"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark texts are normalised to lower-case words and cut into windows
of ``window`` consecutive words (a shorter text is one window).  All windows
go into one automaton; a document's normalised text is scanned once, and each
hit is mapped back to word numbers and to character offsets of the original.

A null text has no words and no hits; so has every text when the benchmark is
empty.  Items with equal windows are all reported.  An item with a null id
still marks words, but has no id to report.  Repeated rows give repeated
results; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WORD, words_of

FINDINGS = ("n_words long, n_hit long, items array<string>, "
            "spans array<struct<start:int,stop:int>>")


class Windows:
    """The automaton over the windows of the items; built once per Python worker."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        import ahocorasick

        found: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i:i + window]
                key = " " + b" ".join(part).decode("utf-8") + " "
                owners = found.setdefault(key, (len(part), set()))[1]
                if item is not None:
                    owners.add(item)
        self.automaton = ahocorasick.Automaton()
        for key, value in found.items():
            self.automaton.add_word(key, value)
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, int, list[str], list[tuple[int, int]]]:
        words = words_of(text)
        if not words or self.empty:
            return len(words), 0, [], []
        flat = " " + b" ".join(words).decode("utf-8") + " "
        hits = list(self.automaton.iter(flat))
        if not hits:
            return len(words), 0, [], []
        spaces = np.flatnonzero(np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32) == 32)
        last = np.searchsorted(spaces, [end for end, _ in hits]) - 1
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        items: set[str] = set()
        for end, (_, (length, owners)) in zip(last, hits):
            marks[end - length + 1] += 1
            marks[end + 1] -= 1
            items |= owners
        inside = np.cumsum(marks[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        at = [m.span() for m in WORD.finditer(text)]
        spans = [(at[a][0], at[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]
        return len(words), int(inside.sum()), sorted(items), spans


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                    max_bytes: int = 4 << 20) -> list[tuple[str | None, str]]:
    """The items, for a benchmark of at most ``max_bytes`` of text.

    The automaton takes some 60 nodes a window on every executor, so a larger
    benchmark raises; it is to be scanned for in parts.
    """
    rows = benchmark.filter(F.col(text_col).isNotNull())
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text, over max_bytes={max_bytes}; scan for it in parts")
    return [(r["i"], r["t"]) for r in rows.select(F.col(id_col).cast("string").alias("i"),
                                                  F.col(text_col).alias("t")).collect()]


def find_contamination(docs: DataFrame, items: list[tuple[str | None, str]], text_col: str = "text",
                       window: int = 10) -> DataFrame:
    """``docs`` with ``found``: words, hit words, items (sorted as text) and spans in the original."""
    shared = docs.sparkSession.sparkContext.broadcast((items, window))

    @F.pandas_udf(FINDINGS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = Windows(*shared.value)
        for texts in batches:
            yield pd.DataFrame([tool.scan(t) for t in texts], columns=["n_words", "n_hit", "items", "spans"])

    return docs.withColumn("found", found(F.col(text_col)))

