"""Sharding by Karmarkar-Karp differencing: near equal bytes, whole groups.

Rows of equal text form a group that must not be split.  A *partial* is a
``k``-tuple of byte sums with the groups behind each; a group starts as
``(bytes, 0, ... 0)``.  Differencing takes the two partials with the largest
spread and adds them in opposite order, the large sums of one to the small
sums of the other.  It runs in two steps: per bucket of groups, in one task
each, and then on the buckets' tuples, up a tree of fixed fan-in; no task
sees more than ``bucket_groups`` groups or ``fan_in`` tuples, and nothing
passes through the driver.

A null text counts no bytes and groups with the empty text.  Repeated rows
are one group.  An empty table gives no rows.  A group larger than a shard's
share is a shard's only group as far as possible: it can't be split.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

ROW_BYTES = 16          # added to each row's text bytes


def difference(sums: np.ndarray) -> np.ndarray:
    """Karmarkar-Karp on ``n`` k-tuples (an n x k array).

    Returns an n x k array: where each place of each tuple goes (0 to k-1).
    Ties go by the tuples' order, so the result depends on the input alone.
    """
    n, k = sums.shape
    place = np.zeros((n, k), dtype=np.int64)
    if not n:
        return place
    heap, sets = [], {}
    for i in range(n):
        order = np.argsort(-sums[i], kind="stable")
        s = sums[i][order]
        sets[i] = [[(i, int(j))] for j in order]
        heap.append((-int(s[0] - s[-1]), i, s))
    heapq.heapify(heap)
    new = n
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        total = x + y[::-1]
        left, right = sets.pop(a), sets.pop(b)
        right.reverse()
        merged = []
        for p, q in zip(left, right):
            if len(p) < len(q):
                p, q = q, p
            p.extend(q)
            merged.append(p)
        order = np.argsort(-total, kind="stable")
        s = total[order]
        sets[new] = [merged[j] for j in order]
        heapq.heappush(heap, (-int(s[0] - s[-1]), new, s))
        new += 1
    for to, members in enumerate(sets[heap[0][1]]):
        for i, j in members:
            place[i, j] = to
    return place


def difference_sizes(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp on single groups: the part (0 to k-1) of each group."""
    n = len(sizes)
    part = np.zeros(n, dtype=np.int64)
    if not n:
        return part
    # a partial: its sums in falling order, and the groups behind each sum
    heap = [(-int(s), i, None, None) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    new = n

    def opened(entry):
        spread, i, sums, members = entry
        if sums is None:
            sums, members = np.zeros(k, dtype=np.int64), [[] for _ in range(k)]
            sums[0], members[0] = -spread, [i]
        return sums, members

    while len(heap) > 1:
        x, left = opened(heapq.heappop(heap))
        y, right = opened(heapq.heappop(heap))
        total = x + y[::-1]
        merged = []
        for p, q in zip(left, reversed(right)):
            if len(p) < len(q):
                p, q = q, p
            if q:
                p.extend(q)
            merged.append(p)
        order = np.argsort(-total, kind="stable")
        s = total[order]
        heapq.heappush(heap, (-int(s[0] - s[-1]), new, s, [merged[j] for j in order]))
        new += 1
    _, members = opened(heap[0])
    for to, m in enumerate(members):
        part[m] = to
    return part


def shard_groups(groups: DataFrame, k: int, n_groups: int, bucket_groups: int = 8192, fan_in: int = 512) -> DataFrame:
    """``groups`` (h1, h2, bytes), a row per group, with the ``shard`` of each."""
    buckets = max(1, -(-n_groups // bucket_groups))

    def parts(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "h1", "h2"], ascending=[False, True, True])
        return frame.assign(part=difference_sizes(frame["bytes"].to_numpy(np.int64), k))[
            ["node", "h1", "h2", "bytes", "part"]]

    cut = staged(groups.withColumn("node", F.pmod(F.col("h1"), F.lit(buckets)))
                 .select("node", "h1", "h2", "bytes")
                 .groupBy("node").applyInPandas(parts, "node long, h1 long, h2 long, bytes long, part long"), "kk-parts")

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["node", "part"])
        nodes = frame["node"].unique()
        sums = np.zeros((len(nodes), k), dtype=np.int64)
        at = np.searchsorted(nodes, frame["node"])
        sums[at, frame["part"]] = frame["bytes"]
        place = difference(sums)
        return pd.DataFrame({"node": np.repeat(nodes, k), "part": np.tile(np.arange(k), len(nodes)),
                             "to": place.ravel()})

    # the tree of tuples: nodes of one level are combined fan_in at a time
    while buckets > 1:
        above = -(-buckets // fan_in)
        tuples = cut.groupBy("node", "part").agg(F.sum("bytes").alias("bytes"))
        moves = (tuples.withColumn("up", F.pmod(F.col("node"), F.lit(above)))
                 .groupBy("up").applyInPandas(combine, "node long, part long, to long"))
        cut = staged(cut.join(moves, ["node", "part"]).select(
            F.pmod(F.col("node"), F.lit(above)).alias("node"), "h1", "h2", "bytes",
            F.col("to").alias("part")), "kk-level")
        buckets = above
    return cut.select("h1", "h2", F.col("part").cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    bucket_groups: int = 8192, slot_rows: int = 50_000) -> DataFrame:
    """A shard and a gapless slot for each document; the law is ``bytes``.

    Returns the id, size, text_crc32, law, shard, slot, grown_shard (null: it
    belongs to the ``key`` law).  Slots go by (sub-bucket of the id's hash,
    id): counts per sub-bucket give each its first slot, so no task orders a
    whole shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit("second"), text).alias("h2")), "shard-rows")
    # one job counts rows and estimates nothing: groups are at most as many as rows
    n = rows.count()
    groups = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"))
    sharded = shard_groups(groups, shards, n, bucket_groups)
    subs = max(1, -(-n // (shards * slot_rows)))
    placed = rows.join(sharded, ["h1", "h2"]).withColumn(
        "sub", F.pmod(F.xxhash64(F.coalesce("doc_id", "h1"), F.lit("slot")), F.lit(subs)))
    placed = staged(placed, "shard-placed")
    first = placed.groupBy("shard", "sub").count()
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("shard", "sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "sub").orderBy("doc_id", "h1", "h2")
    return (placed.withColumn("at", F.row_number().over(within))
            .join(first, ["shard", "sub"])
            .select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("at") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
