"""Mixing sources to target weights.

Each source's words, in a fixed pseudorandom order of its documents, form one
stream that is packed into blocks of ``block_words``.  A mix has a number of
word slots per source; multinomial draws, conditioned on those totals, deal
the slots of each source to the output shards.  Slot ``i`` of a source maps to
block ``perm(i)`` through a keyed Feistel permutation of that source's block
numbers, a new one for each pass over the source, and the blocks are joined by
their index.  The last slot takes only the words still missing, so a source's
words come to its target, rounded, and no document is taken more often than
the passes over its source.

Everything is a function of the rows, so reruns agree.  A document without
words takes no slot.  A null source is a source of its own, after all others.
An empty table gives no rows.  Repeated rows are separate documents; rows that
are equal in all read columns are interchangeable.  Other columns may have any
name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_GOLDEN = 0x9E3779B97F4A7C15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Targets by weight; what goes over ``cap`` times a source's size is reshared until none is above."""
    total, targets = share * sum(sizes), [0.0] * len(sizes)
    active = [i for i in range(len(sizes))]
    while active:
        unit = total / sum(weights[i] for i in active)
        over = [i for i in active if unit * weights[i] > cap * sizes[i]]
        if not over:
            for i in active:
                targets[i] = unit * weights[i]
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
            total -= targets[i]
        active = [i for i in active if i not in set(over)]
    return targets


class Permutation:
    """A keyed permutation of 0 .. n-1: a Feistel network with cycle walking."""

    ROUNDS = 6

    def __init__(self, n: int, *key: int):
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.keys = []
        x = 0x243F6A8885A308D3
        for k in key:
            x = (x ^ (k + 1) * _GOLDEN) & (1 << 64) - 1
            x = (x * 0xBF58476D1CE4E5B9 + (x >> 29)) & (1 << 64) - 1
        for r in range(self.ROUNDS):
            x = (x * 0x94D049BB133111EB + r + 1) & (1 << 64) - 1
            self.keys.append(np.uint64(x ^ x >> 31))

    def _mix(self, x: np.ndarray, r: int) -> np.ndarray:
        x = (x + self.keys[r]) * np.uint64(_GOLDEN)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, rounds) -> np.ndarray:
        h, low = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> h, x & low
        for r in rounds:
            left, right = right, left ^ self._mix(right, r)
        return right << h | left

    def _walk(self, x: np.ndarray, rounds) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=np.uint64), rounds)
        while (far := out >= self.n).any():
            out[far] = self._once(out[far], rounds)
        return out.astype(np.int64)

    def __call__(self, x) -> np.ndarray:
        return self._walk(x, range(self.ROUNDS))

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, range(self.ROUNDS - 1, -1, -1))


class SourcePlan:
    """Slots of one source: ``words`` to take from a stream of ``size`` words."""

    def __init__(self, index: int, size: int, words: int, block_words: int, seed: int):
        self.index, self.size, self.words, self.block = index, size, words, block_words
        self.blocks = -(-size // block_words)
        self.last = size - (self.blocks - 1) * block_words if size else 0
        self.passes = words // size if size else 0
        self.rest = words - self.passes * size
        self.perm = [Permutation(self.blocks, seed, index, e) for e in range(self.passes + 1)] if size else []
        self.slots = self.passes * self.blocks
        if self.rest:
            self.short_at = int(self.perm[-1].inverse(np.array([self.blocks - 1]))[0])
            n = -(-self.rest // block_words)
            n += int(self._before(np.array([n]))[0] < self.rest)
            self.slots += n

    def _before(self, i: np.ndarray) -> np.ndarray:
        """Words in the last pass before its slot ``i``."""
        return i * self.block - (self.block - self.last) * (self.short_at < i)

    def take(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and number of its first words that each slot takes."""
        block, words = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        for e in range(self.passes + 1):
            mine = np.flatnonzero(slot // self.blocks == e)
            if len(mine):
                i = slot[mine] - e * self.blocks
                b = self.perm[e](i)
                length = np.where(b == self.blocks - 1, self.last, self.block)
                block[mine] = b
                words[mine] = length if e < self.passes else np.clip(self.rest - self._before(i), 0, length)
        return block, words


def deal_slots(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws, given each source's total.

    Free multinomial counts could draw a source more often than its target
    allows, so the draws are conditioned on the totals.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    left, out = np.array(slots, dtype=np.int64), []
    for s in range(shards, 0, -1):
        n = -(-int(left.sum()) // s)
        # a very large total is drawn in units, as the sampler bounds its sum
        unit = max(1, -(-int(left.sum()) // 900_000_000))
        drawn = np.minimum(rng.multivariate_hypergeometric(left // unit, min(n // unit, int((left // unit).sum())),
                                                           method="marginals") * unit, left)
        for i in np.argsort(-(left - drawn), kind="stable"):
            more = min(n - int(drawn.sum()), int(left[i] - drawn[i]))
            drawn[i] += max(0, more)
        out.append(drawn)
        left = left - drawn
    return np.array(out, dtype=np.int64).reshape(shards, len(slots))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0,
                block_words: int = 256, output_shards: int = 64, seed: int = 7, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", bucket_rows: int = 50_000,
                max_sources: int = 100_000) -> "Mix":
    """Plan a mix of all documents.

    Sources in order of their code points (null last) weigh ``weights``,
    repeating; together they share ``share`` of all words, and none more than
    ``cap`` times its own.  The driver holds one row per source; more than
    ``max_sources`` sources raise.
    """
    spark = docs.sparkSession
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")), "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    found = per_source.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than max_sources={max_sources} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in found]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, cap)
    plans = [SourcePlan(i, size, min(int(t + 0.5), int(cap * size)), block_words, seed)
             for i, (size, t) in enumerate(zip(sizes, targets))]
    counts = deal_slots([p.slots for p in plans], output_shards, seed)
    table = spark.createDataFrame(
        [(i, r["source"], r["words"], float(t), max(1, -(-r["n"] // bucket_rows)))
         for i, (r, t) in enumerate(zip(found, targets))],
        "source_ix int, source string, source_size long, target double, subs int")
    return Mix(rows, table, plans, counts, block_words)


class Mix:
    def __init__(self, rows: DataFrame, sources: DataFrame, plans: list[SourcePlan], counts: np.ndarray,
                 block_words: int):
        self.sources, self.plans, self.counts, self.block_words = sources, plans, counts, block_words
        self.documents = self._streams(rows)

    def _streams(self, rows: DataFrame) -> DataFrame:
        """Documents with the place of their first word in their source's stream.

        Buckets of the id's hash give the order; their sums give each bucket's
        start, so no task orders a whole source.
        """
        # one row per source, at most max_sources of them: sent to all
        placed = (rows.join(F.broadcast(self.sources.withColumnRenamed("source", "s")),
                            F.col("source").eqNullSafe(F.col("s"))).drop("s")
                  .withColumn("sub", F.pmod(F.xxhash64(F.coalesce("doc_id", "text_hash"), F.lit("mix")), F.col("subs"))))
        sums = placed.groupBy("source_ix", "sub").agg(F.sum("size").alias("words"))
        w = Window.partitionBy("source_ix").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
        firsts = sums.select("source_ix", "sub", F.coalesce(F.sum("words").over(w), F.lit(0)).alias("base"))
        within = (Window.partitionBy("source_ix", "sub").orderBy("doc_id", "size", "text_hash")
                  .rowsBetween(Window.unboundedPreceding, -1))
        return (placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
                .join(firsts, ["source_ix", "sub"])
                .withColumn("start", F.col("base") + F.col("before")).drop("sub", "subs", "base", "before"))

    def pieces(self) -> DataFrame:
        """A row per document and block that holds some of its words: words [a, b) of the block."""
        n, size = self.block_words, F.col("size")
        block = F.explode(F.sequence(F.floor(F.col("start") / n), F.floor((F.col("start") + size - 1) / n)))
        return (self.documents.filter(size > 0).withColumn("block", block)
                .withColumn("a", F.greatest(F.col("start") - F.col("block") * n, F.lit(0)))
                .withColumn("b", F.least(F.col("start") + size - F.col("block") * n, F.lit(n))))

    def slots(self) -> DataFrame:
        """A row per slot: its output shard, source, block and the words it takes of it."""
        spark = self.sources.sparkSession
        total = int(sum(p.slots for p in self.plans))
        first = np.concatenate(([0], np.cumsum([p.slots for p in self.plans]))).astype(np.int64)
        until = np.cumsum(self.counts, axis=0)               # per shard and source
        shared = spark.sparkContext.broadcast((self.plans, first, until))

        def fill(frames):
            plans, first, until = shared.value
            for frame in frames:
                ids = frame["id"].to_numpy(np.int64)
                which = np.searchsorted(first, ids, side="right") - 1
                for s in np.unique(which):
                    slot = ids[which == s] - first[s]
                    block, words = plans[s].take(slot)
                    yield pd.DataFrame({"source_ix": np.full(len(slot), s, np.int32), "block": block, "take": words,
                                        "slot": slot, "shard": np.searchsorted(until[:, s], slot, side="right")})

        return (spark.range(0, total, 1, max(1, -(-total // 1_000_000)))
                .mapInPandas(fill, "source_ix int, block long, take long, slot long, shard long"))

    def taken(self) -> DataFrame:
        """Documents with the words the mix takes of them, repeats counted."""
        pieces, slots = self.pieces(), self.slots()
        taken = F.coalesce(F.col("take"), F.lit(0))          # null: no slot drew the block
        part = F.greatest(F.least(taken, F.col("b")) - F.col("a"), F.lit(0))
        keep = ["source_ix", "start", "doc_id", "text_hash", "size", "source_size", "target"]
        drawn = (pieces.join(slots, ["source_ix", "block"], "left")
                 .groupBy(*keep).agg(F.sum(part).cast("long").alias("taken")))
        # documents without words have no piece
        none = self.documents.filter(F.col("size") == 0).select(*keep, F.lit(0).cast("long").alias("taken"))
        return drawn.unionByName(none)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept.

    A document of ``n`` words of which the mix takes ``t`` comes floor(t / n)
    times, and once more with the chance of the remainder, by a hash of its
    id, text and source: the words of each source stay near its target.
    Documents without words are not part of a mix of words and go.  Rows equal
    in id, text and source share their copies, which all are of one of them.
    Other columns may have any name.
    """
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    # one row per source, at most max_sources of them: sent to all
    names = F.broadcast(mix.sources.select("source_ix", F.col("source").alias("its_source")))
    key = ["doc_id", "text_hash", "its_source"]
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    copies = (mix.taken().filter(F.col("size") > 0).join(names, "source_ix").groupBy(*key)
              .agg((F.sum("taken") / F.max("size")).alias("times"))
              .select(*key, F.floor(F.col("times") + chance).cast("int").alias("copies")).filter("copies > 0"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash")).dropDuplicates(["id", "source", "hash"])
    same = (F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
            & F.col("source").eqNullSafe(F.col("its_source")))
    return (rows.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
