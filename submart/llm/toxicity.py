"""Toxicity with a linear-chain conditional random field.

The field tags each word as neutral or toxic from hashed features of the word
(itself, prefixes, suffixes) and of its neighbours through the transitions.
It learns from labelled tokens: in a toxic document of the training sample,
the words whose stem is tied to toxic documents far beyond chance; in a clean
document, none.  Forward-backward gives each word's marginal; they aggregate
to a score of the document, and words over ``SPAN_AT`` are its offending
spans, as character offsets of the original text.

Sequences are blocks of ``BLOCK`` consecutive words; the whole text is tagged.
A null, empty or wordless text has score 0 and no spans.  Without a toxic or
a clean training row the model scores everything 0.  Repeated rows give
repeated results; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_rows
from .textbytes import Hashes, byte_table, mix, slices, utf8, word_spans
from .words import SEPARATORS

BLOCK = 64                      # words of a sequence
SPAN_AT = 0.5
SLOTS = 1 << 18                 # of the table that finds a feature's weight
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4)
STEMS = (4, 5, 6)               # prefixes that can mark a toxic stem
TOXICITY = "score double, spans array<struct<start:int,stop:int,p:double>>"

# A-Z are folded by the table; they are letters, not separators, in the original bytes
_SEPARATORS = bytes(b for b in SEPARATORS if not 0x41 <= b <= 0x5A)
_TABLE = byte_table(6, fold_case=True)


@dataclass(frozen=True)
class Words:
    start: np.ndarray
    stop: np.ndarray
    text: np.ndarray
    features: np.ndarray        # words x features, hashed


def read_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    start, stop, text = word_spans(buf, offsets, _SEPARATORS)
    h = Hashes(buf, _TABLE)
    size = stop - start
    columns = [h.of(start, stop)]
    for n in PREFIXES:
        columns.append(np.where(size >= n, h.of(start, start + np.minimum(n, size)) + np.uint64(n), np.uint64(0)))
    for n in SUFFIXES:
        columns.append(np.where(size >= n, h.of(stop - np.minimum(n, size), stop) + np.uint64(n + 64), np.uint64(0)))
    return Words(start, stop, text, np.stack(columns, axis=1))


class Weights:
    """Feature weights by hash: a slot holds a feature's whole hash, so an unknown feature weighs nothing."""

    def __init__(self, names: np.ndarray, values: np.ndarray):
        order = np.argsort(np.abs(values), kind="stable")        # of two in a slot, the heavier stays
        slot = self._slot(names[order])
        self.names, self.values = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.float32)
        self.names[slot], self.values[slot] = names[order], values[order]

    @staticmethod
    def _slot(features: np.ndarray) -> np.ndarray:
        return (mix(features) >> np.uint64(46)).astype(np.int64)

    def sums(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(features))
        for k in range(features.shape[1]):
            f = features[:, k]
            slot = self._slot(f)
            out += np.where(self.names[slot] == f, self.values[slot], 0)
        return out


def blocks_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column of each word in the matrix of sequences, and its number of rows."""
    if not len(text):
        return text, text, 0
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    counts = np.diff(np.concatenate((first, [len(text)])))
    at = np.arange(len(text)) - np.repeat(first, counts)
    rows = -(-counts // BLOCK)
    base = np.concatenate(([0], np.cumsum(rows)))
    return np.repeat(base[:-1], counts) + at // BLOCK, at % BLOCK, int(base[-1])


class Field:
    """A binary linear-chain field: emission log-odds and a 2 x 2 transition table."""

    def __init__(self, weights: Weights | None, bias: float, transitions: np.ndarray):
        self.weights, self.bias, self.transitions = weights, bias, transitions

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights.sums(features) + self.bias

    def marginals(self, e: np.ndarray, used: np.ndarray, pairs: bool = False):
        """Per word, the chance of the toxic tag; ``e``, ``used``: sequences x BLOCK.

        Forward and backward messages are kept as log-odds of toxic to neutral.
        Unused places follow the used ones and carry no message back.
        """
        t = self.transitions
        rows, size = e.shape
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for i in range(1, size):
            x = a[:, i - 1]
            a[:, i] = e[:, i] + np.logaddexp(t[0, 1], t[1, 1] + x) - np.logaddexp(t[0, 0], t[1, 0] + x)
        for i in range(size - 2, -1, -1):
            x = e[:, i + 1] + b[:, i + 1]
            m = np.logaddexp(t[1, 0], t[1, 1] + x) - np.logaddexp(t[0, 0], t[0, 1] + x)
            b[:, i] = np.where(used[:, i + 1], m, 0.0)
        p = 1 / (1 + np.exp(-np.clip(a + b, -60, 60)))
        if not pairs:
            return p
        left, right = a[:, :-1], (e + b)[:, 1:]
        logs = np.stack([np.full_like(left, t[0, 0]), t[0, 1] + right, t[1, 0] + left, t[1, 1] + left + right])
        logs -= logs.max(axis=0)
        joint = np.exp(logs)
        joint /= joint.sum(axis=0)
        return p, (joint * used[:, 1:]).sum(axis=(1, 2)).reshape(2, 2)


def copy_groups(words: Words, texts: int, sketches: int = 3, long: int = 7) -> np.ndarray:
    """A group number per text; near copies share one.

    Texts with the same smallest hash among their long words, under any of a
    few hash functions, are in one group: a text that was copied often must
    not make its own rare words look like a pattern.
    """
    parent = np.arange(texts)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    mine = words.stop - words.start >= long
    for k in range(sketches):
        least = np.full(texts, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least, words.text[mine], mix(words.features[mine, 0] + np.uint64(k + 1)))
        first: dict[int, int] = {}
        for i, h in enumerate(least.tolist()):
            if h != np.iinfo(np.uint64).max:
                parent[root(i)] = root(first.setdefault(h, i))
    return np.array([root(i) for i in range(texts)], dtype=np.int64)


def token_labels(words: Words, toxic: np.ndarray) -> np.ndarray:
    """Toxic tags for the words of toxic texts whose stem goes with toxic texts.

    A stem counts once per group of copies.  Of those in three groups at least,
    one is tied to toxic texts when its G-squared passes 2 ln(number of stems),
    so that about none pass by chance, and its odds are 20 times the usual.
    """
    texts = len(toxic)
    group = copy_groups(words, texts)
    of_group = np.zeros(texts)
    np.maximum.at(of_group, group, toxic)
    stems = np.concatenate([words.features[:, 1 + PREFIXES.index(n)] for n in STEMS] + [words.features[:, 0]])
    text = np.tile(group[words.text], len(STEMS) + 1)
    keep = stems != 0
    pairs = np.unique(np.stack([stems[keep], text[keep].astype(np.uint64)], axis=1), axis=0)
    names, at, total = np.unique(pairs[:, 0], return_inverse=True, return_counts=True)
    hits = np.bincount(at, weights=of_group[pairs[:, 1].astype(np.int64)], minlength=len(names))
    often = total >= 3
    names, hits, total = names[often], hits[often], total[often]
    share = of_group[np.unique(group)].mean()
    if not 0 < share < 1:
        return np.zeros(len(words.start), dtype=bool)
    misses = total - hits
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(hits > 0, hits * np.log(hits / (total * share)), 0)
                 + np.where(misses > 0, misses * np.log(misses / (total * (1 - share))), 0))
    odds = ((hits + 0.5) / (misses + 0.5)) / (share / (1 - share))
    tied = names[(g > 2 * np.log(max(len(names), 2))) & (odds > 20) & (hits > share * total)]
    out = np.zeros(len(words.start), dtype=bool)
    for n in STEMS:
        out |= np.isin(words.features[:, 1 + PREFIXES.index(n)], tied)
    out |= np.isin(words.features[:, 0], tied)
    return out & (toxic[words.text] > 0)


def fit(texts: list[str], toxic: list[int], epochs: int = 5, steps: int = 300, batch: int = 512, rate: float = 0.2,
        decay: float = 1e-5, min_texts: int = 3, seed: int = 3) -> Field:
    """Maximum likelihood by Adagrad over mini-batches of sequences.

    Features of fewer than ``min_texts`` texts are left out.  A small sample
    is gone through more often, for ``steps`` steps at least.
    """
    y_text = np.array(toxic, dtype=float)
    untrained = Field(None, 0.0, np.zeros((2, 2)))
    if not len(y_text) or y_text.min() == y_text.max():
        return untrained
    words = read_words(*utf8(pa.array(texts, pa.string())))
    if not len(words.start):
        return untrained
    y = token_labels(words, y_text)
    # number the features a kind at a time, which keeps the sorts small
    names, at, spread = [], np.zeros(words.features.shape, dtype=np.int32), []
    for k in range(at.shape[1]):
        kind, which = np.unique(words.features[:, k], return_inverse=True)
        at[:, k] = which + sum(map(len, names))
        names.append(kind)
        spread.append(np.bincount(np.unique(which * len(texts) + words.text) // len(texts), minlength=len(kind)))
    names, spread = np.concatenate(names), np.concatenate(spread)
    known = (spread >= min_texts) & (names != 0)
    row, column, rows = blocks_of(words.text)
    size = len(names)
    weights, bias, trans = np.zeros(size), -4.0, np.zeros((2, 2))
    g_w, g_b, g_t = np.full(size, 1e-2), 1e-2, np.full((2, 2), 1e-2)
    starts = np.searchsorted(row, np.arange(rows + 1))
    rng = np.random.default_rng(seed)
    for _ in range(max(epochs, -(-steps // -(-rows // batch)))):
        order = rng.permutation(rows)
        for k in range(0, rows, batch):
            mine = np.sort(order[k:k + batch])
            tokens = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in mine])
            place = np.searchsorted(mine, row[tokens]), column[tokens]
            e, used, truth = (np.zeros((len(mine), BLOCK)), np.zeros((len(mine), BLOCK), bool),
                              np.zeros((len(mine), BLOCK)))
            ids = at[tokens]
            e[place] = weights[ids].sum(axis=1) + bias
            used[place] = True
            truth[place] = y[tokens]
            p, joint = Field(None, bias, trans).marginals(e, used, pairs=True)
            d = (truth - p)[place]
            seen = np.array([[((truth[:, :-1] == i) & (truth[:, 1:] == j) & used[:, 1:]).sum() for j in (0, 1)]
                             for i in (0, 1)])
            touched, where = np.unique(ids, return_inverse=True)
            grad = np.bincount(where.ravel(), weights=np.repeat(d, at.shape[1])) - decay * len(mine) * weights[touched]
            grad *= known[touched]
            g_w[touched] += grad ** 2
            weights[touched] += rate * grad / np.sqrt(g_w[touched])
            g_b += d.sum() ** 2
            bias += rate * d.sum() / np.sqrt(g_b)
            g_t += (seen - joint) ** 2
            trans += rate * (seen - joint) / np.sqrt(g_t)
    kept = known & (np.abs(weights) > 0.02)
    return Field(Weights(names[kept], weights[kept].astype(np.float32)), float(bias), trans)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic",
          id_col: str = "doc_id", max_toxic: int = 1200, max_clean: int = 2400, max_chars: int = 6_000) -> Field:
    """Fit on a bounded sample: of each label the first ids by a hash.

    The ids are chosen on the label table alone, and their texts fetched by
    them, so no text is shuffled.  Texts over ``max_chars`` are left out of the
    sample: the driver holds at most ``(max_toxic + max_clean) * max_chars``
    characters.
    """
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
              .filter("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
              .withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit("toxicity"))))
    of: dict = {}
    for label, most in ((1, max_toxic), (0, max_clean)):
        of |= {r["id"]: label for r in first_rows(marked.filter(F.col("toxic") == label), "h", most)}
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .filter(F.col("id").isin(list(of)) & (F.length("text") <= max_chars)))
    sample = sorted(texts.groupBy("id").agg(F.min("text").alias("text")).collect()) if of else []
    return fit([r["text"] for r in sample], [of[r["id"]] for r in sample])


def score_texts(field: Field, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
    """Score and offending spans (as characters) of each text of a slice."""
    n = len(offsets) - 1
    score, spans = np.zeros(n), [[] for _ in range(n)]
    if field.weights is None or not len(buf):
        return score, spans
    words = read_words(buf, offsets)
    if not len(words.start):
        return score, spans
    row, column, rows = blocks_of(words.text)
    e, used = np.zeros((rows, BLOCK)), np.zeros((rows, BLOCK), bool)
    e[row, column] = field.emissions(words.features)
    used[row, column] = True
    p = field.marginals(e, used)[row, column]
    np.maximum.at(score, words.text, p)
    hot = np.flatnonzero(p >= SPAN_AT)
    # several toxic words: the chance that one at least is
    clean = np.ones(n)
    np.multiply.at(clean, words.text[hot], 1 - p[hot])
    score = np.maximum(score, 1 - clean)
    # characters before each byte: bytes that begin one
    chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80))) if len(hot) else None
    for i in hot:
        t = int(words.text[i])
        before = int(chars[offsets[t]])
        spans[t].append({"start": int(chars[words.start[i]]) - before, "stop": int(chars[words.stop[i]]) - before, "p": float(p[i])})
    return np.clip(score, 0.0, 1.0), spans


def tag_toxicity(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``: a struct of the score and the offending spans."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))

    @F.arrow_udf(TOXICITY)
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            scores, spans = [], []
            for i, j in slices(texts):
                s, found = score_texts(model, *utf8(texts[i:j]))
                scores.append(s)
                spans += found
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(spans, span)],
                names=["score", "spans"])

    return docs.withColumn("toxicity", toxicity(F.col(text_col)))
