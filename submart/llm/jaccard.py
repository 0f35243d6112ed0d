"""N-gram Jaccard join by universe-partition pigeonhole.

A text's set is its distinct word shingles, as 64-bit hashes.  Two sets of
similarity t or more differ in at most ``(1-t)/(1+t) * (|a|+|b|)`` shingles.
Sizes fall into bands of ratio 1/t, so such sets are in the same or in
neighbouring bands; every set is signed for its own band and the next.  A band
whose sets differ in at most H shingles cuts the universe of hashes into
segments with weights v of 0, 1 or 2: a segment of weight 1 is indexed by the
hash of its subset, one of weight 2 by that and by its one-deletion
neighbourhood.  When the weights sum to more than H, similar sets agree in the
index of some segment.

Allocation by cost: a first pass estimates, per band and segment, the second
moment of the subsets' frequencies (a sum of random signs, a few counters
each).  A segment whose pairs cost more than indexing the deletions of another
gets weight 0, and the other weight 2.

Empty subsets agree without meaning.  A band has ``spare`` weight above H+1, so
similar sets agree in segments that weigh ``spare + 1`` or more.  A set whose
empty segments weigh no more than ``spare`` leaves them out of its index, as
another must agree as well; what is left is the number of signatures it
``needs`` to share with any set similar to it.  A set that shares fewer in all
is not linked, and a pair that shares fewer is not verified.

A candidate pair first compares two odd sketches, bits that each shingle of a
set toggles: they differ in no more bits than the sets differ in shingles, so
too many differing bits rule a pair out for certain.  What is left is verified
exactly on the shingles of both texts.  Candidates are
looked for in two steps, so that a group of near copies never forms all its
pairs: each set with the set it shares most segments with by way of the
segments' smallest sets, then, between different components only, all sets
that share a segment.  What is left out is connected already.  Where many sets
share a segment, those with too many shingles of their own are left out of it,
so documents of one template don't form all their pairs.

Texts of the same set are one node.  A text with fewer words than a shingle is
one shingle; without words, or null, it has none and links with nothing.
Repeated rows are copies of each other.  A null id stays null and never names
a component that has another id.  Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, staged
from .components import connected_components
from .textbytes import SPACES, Hashes, byte_table, mix, slices, utf8, word_spans

_TABLE = byte_table(1, fold_case=True)
SKETCH = [f"s{i}" for i in range(8)]       # 64 bits each
SPARE = 0.5                     # of a band's segments, beyond those that its similar sets can differ in
CROWD = 64                      # sets of a signature from which on their own shingles are counted
_SIGNS = 8                      # counters of a segment's second moment
HOT = 16                        # times the usual pairs and members that a segment's pairs are worth avoiding
_STAT_SEGMENTS = 4096           # bands of longer sets have few members and keep the plain allocation


@dataclass(frozen=True)
class Threshold:
    """Similar when ``den * intersection >= num * union``, over shingles of ``words`` words."""

    words: int
    num: int
    den: int

    def bands(self, largest: int) -> np.ndarray:
        """First size of each band: two similar sizes are at most one band apart."""
        starts = [1]
        while starts[-1] <= largest * self.den // self.num + 2:
            # the smallest size that is not similar to the band's first
            starts.append(starts[-1] * self.den // self.num + 1)
        return np.array(starts, dtype=np.int64)

    def difference(self, a: int, b: int) -> int:
        """The most shingles in which similar sets of these sizes differ."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)


@dataclass
class Scheme:
    """Segments and weights of each band."""

    threshold: Threshold
    changes: dict[int, tuple[list[int], list[int]]] = field(default_factory=dict)   # band: segments of weight 0, of 2

    def segments(self, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the bands, and per band its segments and spare weight."""
        starts = self.threshold.bands(largest)
        most = np.concatenate((starts[1:] - 1, [starts[-1] * 2]))
        h = np.array([self.threshold.difference(int(m), int(m)) for m in most])
        m = np.ceil((1 + SPARE) * (h + 1))
        empties = m * np.exp(-starts / m)
        # a set of one shingle has no other segment; larger ones rarely have more empties than this
        spare = np.ceil(np.maximum(m - h - 1, empties + 3 * np.sqrt(empties) + 2))
        spare = np.where(h == 0, 0, spare).astype(np.int64)
        return starts, h + 1 + spare, spare


class Shingles:
    """Distinct shingle hashes of a slice of texts, sorted within each text."""

    def __init__(self, column: pa.Array, words: int):
        buf, offsets = utf8(column)
        start, stop, text = word_spans(buf, offsets, SPACES)
        n, k = len(column), words
        counts = np.bincount(text, minlength=n).astype(np.int64)
        if len(start):
            w = Hashes(buf, _TABLE).of(start, stop)
            total = np.zeros(max(0, len(w) - k + 1), dtype=np.uint64)
            for j in range(k):
                total += mix(w[j:len(w) - k + 1 + j] + np.uint64(j * 0x51ED27 + 7))
            whole = text[:len(total)] == text[k - 1:] if len(total) else np.zeros(0, bool)
            hashes, owner = mix(total[whole]), text[:len(total)][whole]
            # texts of fewer words: one shingle of all of them
            short = np.flatnonzero((counts > 0) & (counts < k))
            if len(short):
                first = np.concatenate(([0], np.cumsum(counts)))[short]
                total = np.zeros(len(short), dtype=np.uint64)
                for j in range(k - 1):
                    has = counts[short] > j
                    total[has] += mix(w[first[has] + j] + np.uint64(j * 0x51ED27 + 7))
                hashes = np.concatenate((hashes, mix(total + counts[short].astype(np.uint64))))
                owner = np.concatenate((owner, short))
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            self.hashes, self.owner = hashes[new], owner[new]
        else:
            self.hashes, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts = np.bincount(self.owner, minlength=n).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.hashes ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)))
        #: one number per set: equal sets have equal nodes
        self.nodes = mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.counts.astype(np.uint64)).astype(np.int64)

    def sketches(self) -> np.ndarray:
        """Odd sketches, one row of int64 per set."""
        bits = 64 * len(SKETCH)
        at = self.owner * bits + ((mix(self.hashes) >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(at, minlength=len(self.counts) * bits).reshape(len(self.counts), bits) & 1
        return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)

    def wide_sketch(self, i: int) -> bytes:
        """The odd sketch of one set in a power of two of at least two bits a shingle."""
        bits = max(512, 1 << (2 * int(self.counts[i]) - 1).bit_length())
        at = (mix(self.of(i) ^ np.uint64(0x77)) >> np.uint64(32)) & np.uint64(bits - 1)
        odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]:self.first[i + 1]]


class Signer:
    """Signatures of a slice's sets under a scheme."""

    def __init__(self, scheme: Scheme, largest: int):
        self.scheme = scheme
        self.starts, self.m, self.spare = scheme.segments(largest)
        self.base = np.concatenate(([0], np.cumsum(self.m)))       # of each band's segments in one row
        self.weight = np.ones(self.base[-1], dtype=np.int8)
        for band, (none, two) in scheme.changes.items():
            if band < len(self.m):
                self.weight[self.base[band] + np.array(none, dtype=np.int64)] = 0
                self.weight[self.base[band] + np.array(two, dtype=np.int64)] = 2

    def subsets(self, s: Shingles, up: int):
        """Per set and segment of the band ``up`` above its own: set, segment (over all bands), hash sum, size."""
        sets = np.flatnonzero(s.counts)
        band = np.searchsorted(self.starts, s.counts[sets], side="right") - 1 + up
        m = self.m[band]
        out = np.concatenate(([0], np.cumsum(m)))
        where = np.full(len(s.counts), -1, dtype=np.int64)
        where[sets] = np.arange(len(sets))
        at = where[s.owner]
        segment = ((s.hashes >> np.uint64(32)) * m[at].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        place = out[at] + segment                                   # grows, as hashes are sorted within a set
        size = np.bincount(place, minlength=out[-1])
        token = mix(s.hashes)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(token, dtype=np.uint64)))
        edge = np.concatenate(([0], np.cumsum(size)))
        total = sums[edge[1:]] - sums[edge[:-1]]
        owner = np.repeat(sets, m)
        global_segment = np.arange(out[-1]) - np.repeat(out[:-1], m) + np.repeat(self.base[band], m)
        return owner, global_segment, total, size, place, token, np.repeat(band, m)

    def needs(self, s: Shingles) -> np.ndarray:
        """The fewest signatures that each set shares with any similar set in an even and in an odd band.

        Under the plain allocation; sets that meet in a band share that many of that band.
        """
        out = np.ones((2, len(s.counts)), dtype=np.int64)
        for up in (0, 1):
            owner, _, _, size, _, _, band = self.subsets(s, up)
            blank = np.bincount(owner[size == 0], minlength=len(s.counts))
            spare, odd = np.zeros((2, len(s.counts)), dtype=np.int64)
            spare[owner], odd[owner] = self.spare[band], band & 1
            has = np.flatnonzero(s.counts)
            out[odd[has], has] = np.where(blank > spare, 1, spare + 1 - blank)[has]
        return out

    @staticmethod
    def _key(total: np.ndarray, segment: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The signature of a subset; its lowest bit tells an even band from an odd one."""
        key = mix(total + mix(segment.astype(np.uint64) + np.uint64(0x5EED)))
        return key & ~np.uint64(1) | (band & 1).astype(np.uint64)

    def signatures(self, s: Shingles) -> tuple[np.ndarray, np.ndarray]:
        """Signature and node, of all sets of the slice."""
        keys, nodes = [], []
        for up in (0, 1):
            owner, segment, total, size, place, token, band = self.subsets(s, up)
            if not len(owner):
                continue
            weight = self.weight[segment]
            # segments that may agree on the empty subset, and what they weigh in each set
            blank = np.where(weight == 2, size <= 1, (weight == 1) & (size == 0))
            heavy = np.zeros(len(s.counts), dtype=np.int64)
            np.add.at(heavy, owner[blank], weight[blank])
            over = heavy[owner] > self.spare[band]
            use = (weight > 0) & ((size > 0) | over)
            keys.append(self._key(total[use], segment[use], band[use]))
            nodes.append(s.nodes[owner[use]])
            two = weight[place] == 2                                # one-deletion neighbourhoods, a token at a time
            two &= (size[place] > 1) | over[place]
            if two.any():
                at = place[two]
                keys.append(self._key(total[at] - token[two], segment[at], band[at]))
                nodes.append(s.nodes[owner[at]])
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(nodes)


def _sets(docs: DataFrame, threshold: Threshold, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Per document its id, text's hash, size and node; per band its members and the segments' sign sums."""
    k = threshold.words
    schema = "kind string, doc_id bigint, th bigint, n bigint, node bigint, need0 bigint, need1 bigint, band int, signs binary, " + ", ".join(
        f"{c} bigint" for c in SKETCH)

    names = ["kind", "doc_id", "th", "n", "node", "need0", "need1", "band", "signs", *SKETCH]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats: dict[int, list] = {}
        signer = None
        for batch in batches:
            ids, hashes, column = batch.columns
            for i, j in slices(column):
                s = Shingles(column[i:j], k)
                n = j - i
                largest = int(s.counts.max(initial=0))
                if signer is None or largest >= signer.starts[-3]:
                    signer = Signer(Scheme(threshold), 4 * max(largest, 1000))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["set"] * n), ids[i:j], hashes[i:j], pa.array(s.counts), pa.array(s.nodes), *map(pa.array, signer.needs(s)),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *map(pa.array, s.sketches().T.copy())],
                    names=names)
                if not len(s.hashes):
                    continue
                owner, segment, total, size, _, _, band = signer.subsets(s, 0)
                keep = (size > 0) & (signer.m[band] <= _STAT_SEGMENTS)
                bits = mix(total[keep] + np.uint64(99))
                local = segment[keep] - signer.base[band[keep]]
                for b in np.unique(band[keep]):
                    mine = band[keep] == b
                    members, sums = stats.setdefault(int(b), [0, np.zeros((signer.m[b], _SIGNS), np.int64)])
                    stats[int(b)][0] = members + len(np.unique(owner[keep][mine]))
                    for c in range(_SIGNS):
                        sign = 1 - 2 * ((bits[mine] >> np.uint64(c)) & np.uint64(1)).astype(np.int64)
                        sums[:, c] += np.bincount(local[mine], weights=sign, minlength=len(sums)).astype(np.int64)
        if stats:
            order = sorted(stats)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["band"] * len(order)), pa.nulls(len(order), pa.int64()), pa.nulls(len(order), pa.int64()),
                 pa.array([stats[b][0] for b in order], pa.int64()), pa.nulls(len(order), pa.int64()),
                 pa.nulls(len(order), pa.int64()), pa.nulls(len(order), pa.int64()), pa.array(order, pa.int32()),
                 pa.array([stats[b][1].tobytes() for b in order], pa.binary()),
                 *[pa.nulls(len(order), pa.int64()) for _ in SKETCH]], names=names)

    text = F.col(text_col).cast("string")
    rows = staged(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
                  .mapInArrow(read, schema), "jaccard-sets")
    return (rows.filter("kind = 'set'").select("doc_id", "th", "n", "node", "need0", "need1", *SKETCH),
            rows.filter("kind = 'band'").select("band", "n", "signs"))


def _allocate(stats: DataFrame, threshold: Threshold) -> Scheme:
    """Weights by cost; only the changed segments of a band come to the driver."""
    scheme = Scheme(threshold)

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        band, members = int(frame["band"].iloc[0]), int(frame["n"].sum())
        sums = sum(np.frombuffer(x, dtype=np.int64).reshape(-1, _SIGNS) for x in frame["signs"])
        pairs = np.maximum((sums.astype(float) ** 2).mean(axis=1) - members, 0) / 2
        usual = np.median(pairs)
        order = np.argsort(-pairs, kind="stable")
        cheap = list(np.argsort(pairs, kind="stable"))
        none, two = [], []
        for j in order[:len(order) // 4]:
            # pairs that come up in most segments are near copies, which no allocation avoids.  What a
            # segment has beyond that costs a row each; a deletion neighbourhood some 8 rows a set, and
            # the band's sets lose their needs, which filter most other pairs
            if pairs[j] <= HOT * (usual + members):
                break
            none.append(int(j))
            two.append(int(cheap[len(two)]))
        return pd.DataFrame({"band": [band], "none": [none], "two": [two]})

    found = (stats.groupBy("band").applyInPandas(choose, "band int, none array<int>, two array<int>")
             .filter("size(none) > 0").collect())
    scheme.changes = {r["band"]: (list(r["none"]), list(r["two"])) for r in found}
    return scheme


def _memberships(docs: DataFrame, scheme: Scheme, largest: int, parts: int, id_col: str, text_col: str,
                 chunk: int = 750_000) -> DataFrame:
    """``sig``, ``node`` of every signature that two different sets have.

    Signatures go out as packed arrays, one per chunk and part.  Within a
    chunk a signature sends at most two of its nodes to its part, which is
    enough to show that it is shared; others, known to be shared, go to parts
    dealt by node.  So no part gets more than two rows a chunk for a signature.
    """
    threshold = scheme.threshold

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(scheme, largest)
        keys, nodes, held = [], [], 0
        for batch in batches:
            column = batch.column(0)
            for i, j in slices(column):
                k, n = signer.signatures(Shingles(column[i:j], threshold.words))
                keys.append(k)
                nodes.append(n)
                held += len(k)
                if held >= chunk:
                    yield pack(np.concatenate(keys), np.concatenate(nodes))
                    keys, nodes, held = [], [], 0
        if held:
            yield pack(np.concatenate(keys), np.concatenate(nodes))

    def pack(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((nodes, keys))                           # also by part, which is the key's top bits
        keys, nodes, part = keys[order], nodes[order], part[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, part = keys[new], nodes[new], part[new]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        rank = np.arange(len(keys)) - np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
        rest = rank >= 2
        part = np.where(rest, parts + nodes % parts, part)
        order = np.argsort(part, kind="stable")
        keys, nodes, part = keys[order], nodes[order], part[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        ends = np.concatenate((cuts[1:], [len(part)]))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[cuts]), pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
             pa.array([nodes[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())],
            names=["part", "keys", "nodes"])

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["keys"]])
        nodes = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame["nodes"]])
        if frame["part"].iloc[0] >= parts:
            return pd.DataFrame({"sig": keys, "node": nodes})
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        same = keys[1:] == keys[:-1]
        keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        return pd.DataFrame({"sig": keys[keep], "node": nodes[keep]})

    packed = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        sign, "part bigint, keys binary, nodes binary")
    return staged(packed.groupBy("part").applyInPandas(shared, "sig bigint, node bigint"), "jaccard-shared")


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two wide sketches differ, the longer folded to the shorter: at most the sets' difference."""
    x, y = (int.from_bytes(s, "little") for s in (a, b))
    size, least = 8 * max(len(a), len(b)), 8 * min(len(a), len(b))
    if len(a) < len(b):
        x, y = y, x
    while size > least:
        size //= 2
        x = (x >> size) ^ (x & (1 << size) - 1)
    return (x ^ y).bit_count()


def _verified(pairs: DataFrame, texts: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose sets are similar.

    Wide sketches, some twentieth of a text, go to the pairs first and rule out
    most that are not; the texts of the others decide, by the shingles of both.
    """
    k, num, den = threshold.words, threshold.num, threshold.den

    @F.arrow_udf("boolean")
    def close(left: pa.Array, right: pa.Array, most: pa.Array) -> pa.Array:
        return pa.array([sketch_distance(a, b) <= m for a, b, m in zip(left.to_pylist(), right.to_pylist(),
                                                                       most.to_pylist())], pa.bool_())

    most = F.expr(f"cast((n_a + n_b) * {den - num} div {den + num} as bigint)")
    sketched = (pairs.join(texts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("wide").alias("w_a")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("wide").alias("w_b")), "b"))
    pairs = staged(sketched.filter(close("w_a", "w_b", most)).select("a", "b"), "jaccard-close")

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = np.zeros(len(left), dtype=bool)
        for i, j in slices(left):
            for x, y in slices(right[i:j]):
                a, b = Shingles(left[i + x:i + y], k), Shingles(right[i + x:i + y], k)
                for r in range(y - x):
                    p, q = a.of(r), b.of(r)
                    both = len(p) + len(q) - len(np.union1d(p, q)) if len(p) and len(q) else 0
                    out[i + x + r] = both > 0 and den * both >= num * (len(p) + len(q) - both)
        return pa.array(out)

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return staged(joined.filter(similar("text_a", "text_b")).select("a", "b"), "jaccard-links")


def jaccard_components(docs: DataFrame, threshold: Threshold, id_col: str = "doc_id", text_col: str = "text",
                       part_rows: int = 1_000_000, id_filter_bits: int = 22) -> DataFrame:
    """One row per document: ``doc_id``, ``th``, ``n_shingles``, ``component_id``, ``node`` and ``root``.

    ``th`` is the xxhash64 of the text; ``node`` is the hash of the shingle set; ``component_id`` is the smallest
    id reachable by links, the document's own included.  ``root`` is the
    component's smallest node: unlike the id, it is never null and never
    shared by components (rows of one id can have different texts).
    """
    sets, stats = _sets(docs, threshold, id_col, text_col)
    total, largest = sets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    classes = sets.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"),
                                                       F.min("need0").alias("need0"), F.min("need1").alias("need1"),
                                                       *[F.min(c).alias(c) for c in SKETCH])
    scheme = _allocate(stats, threshold)
    # needs hold for the plain allocation; where it was changed, one shared signature is enough
    starts = threshold.bands(4 * largest + 1000)
    for band in scheme.changes:
        low, high = int(starts[max(band - 1, 0)]), int(starts[band + 1])
        need = f"need{band % 2}"
        classes = classes.withColumn(need, F.when((F.col("n") >= low) & (F.col("n") < high), 1).otherwise(F.col(need)))
    rate = 2.2 * (1 + SPARE) * (threshold.den - threshold.num) / (threshold.den + threshold.num) * 2
    parts = max(1, int(total * rate) // part_rows + 1)
    shared = _memberships(docs, scheme, largest, parts, id_col, text_col)
    odd = F.col("sig").bitwiseAND(F.lit(1)) == 1
    has = [F.count_if(odd == bool(p)).alias(f"has{p}") for p in (0, 1)]
    nodes = staged(shared.groupBy("node").agg(*has).join(classes, "node")
                   .filter("has0 >= need0 or has1 >= need1"), "jaccard-nodes")
    # a set that shares too few signatures of a band meets no similar set in it
    shared = (shared.join(nodes.select("node", "has0", "has1", "need0", "need1"), "node")
              .select("sig", "node", F.when(odd, F.col("has1")).otherwise(F.col("has0")).alias("has"),
                      F.when(odd, F.col("need1")).otherwise(F.col("need0")).alias("need"))
              .filter("has >= need").drop("has"))
    texts = _texts(docs, nodes, threshold, id_col, text_col, id_filter_bits)

    # 1: each set with the one that leads most of its segments.  The set whose segments are the most
    # common leads: of a group of near copies that is the one closest to all others
    common = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("sets"))
    weight = shared.join(common, "sig").groupBy("node").agg(F.sum("sets").alias("weight"))
    led = staged(shared.join(weight, "node"), "jaccard-weights")
    lead = led.groupBy("sig").agg(F.max(F.struct("weight", "node")).alias("top")).select(
        "sig", F.col("top.node").alias("lead"))
    best = (shared.join(lead, "sig").filter("node <> lead").groupBy("node", "need", "lead", odd).count()
            .filter("count >= need").groupBy("node").agg(F.max(F.struct("count", "lead")).alias("best")))
    t = threshold
    near = (F.col("n") * t.den >= F.col("m") * t.num) & (F.col("m") * t.den >= F.col("n") * t.num)
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"t{c}"))) for c in SKETCH)
    near &= apart * (t.den + t.num) <= (F.col("n") + F.col("m")) * (t.den - t.num)
    other = [F.col(c).alias(f"t{c}") for c in SKETCH]
    tried = staged(best.select(F.col("node").alias("a"), F.col("best.lead").alias("b"))
                   .join(nodes.select(F.col("node").alias("a"), "n", *SKETCH), "a")
                   .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), *other), "b")
                   .filter(near).select("a", "b"), "jaccard-tried")
    links = _verified(tried, texts, threshold)
    first = connected_components(links)

    # 2: pairs between components; within each signature, all but its main component against all
    of = nodes.join(first, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component"),
                                                   *SKETCH)
    rows = shared.join(of, "node")
    mixed = (rows.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .filter("x <> y").select("sig"))
    rows = _without_loners(staged(rows.join(mixed, "sig"), "jaccard-mixed"), texts, threshold)
    main = (rows.groupBy("sig", "component").count().groupBy("sig")
            .agg(F.max(F.struct("count", "component")).alias("top"))
            .select("sig", F.col("top.component").alias("main")))
    rows = rows.join(main, "sig")
    others = rows.filter("component <> main").select("sig", F.col("node").alias("a"), F.col("n").alias("n"),
                                                     F.col("component").alias("ca"), F.col("need").alias("na"),
                                                     F.col("own").alias("oa"), *SKETCH)
    everyone = rows.select("sig", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("cb"),
                           F.col("need").alias("nb"), F.col("own").alias("ob"), *other, (F.col("component") == F.col("main")).alias("is_main"))
    near &= (F.col("oa") + F.col("ob")) * (t.den + t.num) <= (F.col("n") + F.col("m")) * (t.den - t.num)
    pairs = (others.join(everyone, "sig")
             .filter((F.col("ca") != F.col("cb")) & (F.col("is_main") | (F.col("a") < F.col("b"))) & near)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                     F.greatest("na", "nb").alias("need"), odd.alias("odd"))
             .groupBy("a", "b", "need", "odd").count().filter("count >= need").select("a", "b").distinct())
    pairs = staged(pairs, "jaccard-pairs")
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verified(pairs.join(done, ["a", "b"], "left_anti"), texts, threshold)
    lookup = of.select("node", "component")
    across = (more.join(lookup.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
              .join(lookup.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
              .select(F.col("x").alias("a"), F.col("y").alias("b")))
    second = connected_components(across).withColumnRenamed("component", "root")
    final = (of.join(second.withColumnRenamed("node", "component"), "component", "left")
             .select("node", F.coalesce("root", "component").alias("root")))
    smallest = (final.join(nodes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("smallest")))
    named = final.join(smallest, "root").select("node", "smallest", "root")
    by_node = classes.join(named, "node", "left").select("node", F.coalesce("smallest", "rep").alias("component_id"),
                                                         F.coalesce("root", "node").alias("root"))
    return (sets.join(by_node, "node", "left")
            .select("doc_id", "th", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "node", F.coalesce("root", "node").alias("root")))


def _without_loners(rows: DataFrame, texts: DataFrame, threshold: Threshold) -> DataFrame:
    """``rows`` with ``own``, less those of crowded signatures whose set differs too much from all others.

    Documents of one template crowd its segments without being similar.  The
    shingles that a set shares with no other set of any crowded signature,
    ``own``, are missing from each set it meets there.  A set is left out of
    crowded signatures when they are more than it may lack; a pair is ruled out
    when both sets' are more than the pair may differ in.  In other signatures
    ``own`` is 0.
    """
    k = threshold.words
    crowded = (rows.groupBy("sig").agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") > CROWD)
               .select("sig", F.lit(True).alias("crowded")))
    crowd = staged(rows.join(crowded, "sig").select("node").distinct(), "jaccard-crowd")
    if crowd.isEmpty():
        return rows.withColumn("own", F.lit(0))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(0)):
                s = Shingles(batch.column(0)[i:j], k)
                yield pa.RecordBatch.from_arrays([pa.array(s.hashes.view(np.int64)), pa.array(s.nodes[s.owner])],
                                                 names=["shingle", "node"])

    own = (texts.join(crowd, "node").select("text").mapInArrow(shingles, "shingle bigint, node bigint")
           .groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("node")).filter("sets = 1")
           .groupBy("node").agg(F.count(F.lit(1)).alias("alone")))
    rows = (rows.join(crowded, "sig", "left").join(own, "node", "left")
            .withColumn("own", F.when(F.col("crowded"), F.coalesce("alone", F.lit(0))).otherwise(0)))
    may = F.col("own") * threshold.den <= F.col("n") * (threshold.den - threshold.num)
    return staged(rows.filter(may).drop("crowded", "alone"), "jaccard-met")


def _texts(docs: DataFrame, nodes: DataFrame, threshold: Threshold, id_col: str, text_col: str, bits: int) -> DataFrame:
    """One text per node that shares a signature; a fixed-size filter keeps most others out of the shuffle."""
    k = threshold.words
    wanted = nodes.select(F.coalesce("rep", F.lit(-1)).alias("rep"), "node")
    may = IdFilter(wanted, "rep", bits)
    hits = may.hits
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-1)).alias("rep"),
                       F.col(text_col).cast("string").alias("text")).withColumn("bit", may.bit(F.col("rep")))

    # the filter and the sets in one pass, so a task has one Python worker
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(hits(batch.column(2).to_numpy())))
            for i, j in slices(batch.column(1)):
                s = Shingles(batch.column(1)[i:j], k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], batch.column(1)[i:j], pa.array(s.nodes), pa.array(s.counts),
                     pa.array([s.wide_sketch(r) if s.counts[r] else b"" for r in range(j - i)], pa.binary())],
                    names=["rep", "text", "node", "n", "wide"])

    found = rows.mapInArrow(sets_of, "rep bigint, text string, node bigint, n bigint, wide binary")
    return staged(found.join(wanted, ["node", "rep"]).dropDuplicates(["node"]).select("node", "n", "wide", "text"),
                  "jaccard-texts")


def keep_one_of_each(docs: DataFrame, threshold: Threshold, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay: of each component one row, its smallest id; wordless rows all stay.

    All columns are kept.  Of rows with the same id and set, one stays.  A
    null id counts as larger than all others.  Rows are met again by id and by
    the hash of their text, so no set is built twice.
    """
    found = jaccard_components(docs, threshold, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "th"))
    stay = (found.filter("n_shingles > 0").groupBy("root").agg(first.alias("s"))
            .select(F.col("s.doc_id").alias("stay_id"), F.col("s.th").alias("stay_th")))
    text = F.col(text_col).cast("string")
    wordless = F.coalesce(~text.rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    rows = docs.select(F.struct("*").alias("row"), wordless.alias("wordless"), F.xxhash64(text).alias("th"))
    one = (rows.filter("not wordless")
           .join(stay, F.col("th").eqNullSafe(F.col("stay_th")) & F.col(f"row.`{id_col}`").eqNullSafe(F.col("stay_id")))
           .dropDuplicates(["stay_id", "stay_th"]).select("row.*"))
    return one.unionByName(rows.filter("wordless").select("row.*"))
