"""Conversations as blocks of consecutive turns, and streams over them.

Nearly every conversation is one block and is shuffled once, by its id.  One
that weighs more than a block is cut into blocks along prefix sums that Spark
computes in pieces, so that no task holds more than a block however many turns
a conversation has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

#: weight of a turn beside the bytes of its text
TURN_WEIGHT = 256
BLOCK_BYTES = 8 << 20


def turn_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, in which rows are ordered, and the text's ``head``, by which they are ranged."""
    return rows.select("conv_id", "turn", "role", "text", F.substring("text", 1, 32).alias("head"))


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]


def _weight():
    return F.lit(TURN_WEIGHT).cast("bigint") + F.coalesce(F.octet_length("text"), F.lit(0))


def split_long(rows: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations within a block, and those of longer ones (None when there are none)."""
    long = staged(rows.groupBy("conv_id").agg(F.sum(_weight()).alias("w")).filter(F.col("w") > block_bytes)
                  .select(F.col("conv_id").alias("long_id")), "long-conversations")
    if long.isEmpty():
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def in_blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of long conversations with ``at`` (position from 0) and ``block``.

    The rows are ranged over partitions and written with their place.  Sums
    within a conversation's rows of one partition, and over the partitions'
    totals, give every row what weighs before it; a block starts with each
    multiple of ``block_bytes``.
    """
    placed = staged(rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
                                            F.col("role").asc_nulls_first(), F.col("head").asc_nulls_first())
                    .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_order())
                    .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
                    .withColumn("weight", _weight()), "placed-turns")
    totals = placed.groupBy("conv_id", "part").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("c"), F.col("part").alias("p"),
                           F.coalesce(F.sum("w").over(parts), F.lit(0)).alias("w_before"),
                           F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("n_before"))
    here = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = (placed.withColumn("w_here", F.coalesce(F.sum("weight").over(here), F.lit(0)))
              .withColumn("n_here", F.count(F.lit(1)).over(here)))
    found = summed.join(totals, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return staged(found.select("conv_id", "turn", "role", "text", (F.col("n_before") + F.col("n_here")).alias("at"),
                               F.floor((F.col("w_before") + F.col("w_here")) / F.lit(block_bytes)).cast("bigint")
                               .alias("block")), "turn-blocks")


def whole(rows: DataFrame) -> DataFrame:
    """Rows of short conversations, a conversation's rows next to each other and in order."""
    return (rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_order())
            .select("conv_id", "turn", "role", "text"))


def by_block(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of long conversations, a block's rows next to each other and in order."""
    return rows.repartition("conv_id", "block").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "block", *order)


def by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def _size(value) -> int:
    """About how many bytes a value of an output row takes."""
    if isinstance(value, str):
        return 50 + len(value)
    if isinstance(value, (list, tuple)):
        return 50 + sum(map(_size, value))
    if isinstance(value, dict):
        return 50 + sum(map(_size, value.values()))
    return 16


def stream(rows: DataFrame, keys: int, schema: T.StructType, work: Callable[[Iterator[tuple]], Iterator[tuple]],
           batch_bytes: int = 1 << 20) -> DataFrame:
    """``work`` over a task's rows, as (key, iterator of rows) for each run of equal first ``keys`` columns.

    A row is a tuple of all columns.  ``work`` may keep a run or only pass over
    it; what it yields goes out in batches of about ``batch_bytes``.
    """
    fields = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)

        def tuples():
            for batch in batches:
                for i in range(0, batch.num_rows, 1024):
                    yield from zip(*[c.to_pylist() for c in batch.slice(i, 1024).columns])

        out, size = [], 0
        for row in work(itertools.groupby(tuples(), key=lambda r: r[:keys])):
            out.append(row)
            size += _size(row)
            if size >= batch_bytes:
                yield pa.RecordBatch.from_pylist([dict(zip(fields, r)) for r in out], schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(fields, r)) for r in out], schema=arrow)

    return rows.mapInArrow(run, schema)
