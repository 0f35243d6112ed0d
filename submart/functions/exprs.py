"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the description given to a lookup that has no match or a
#: NULL description.
UNKNOWN = "~UNK"


def conditional_sum(value: str | Column, condition: Column) -> Column:
    """``COALESCE(SUM(CASE WHEN cond THEN COALESCE(value, 0) END), 0)``.

    Rows failing ``condition`` are not filtered out; they add nothing, so a
    group with no qualifying row yields 0 rather than disappearing.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, F.coalesce(v, F.lit(0)))), F.lit(0))


def unknown_default(col: str | Column, unknown: str = UNKNOWN) -> Column:
    """Replace both "no match" and "matched but NULL" with ``unknown``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(unknown))


def key_cast(col: str | Column, type_name: str = "int") -> Column:
    """``cast(x as <type>)`` that yields NULL on bad text instead of failing.

    Spark 4 runs with ANSI on, where a plain cast of ``'abc'`` raises; the
    jobs were written for a Spark that returned NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(type_name)


def sum_result_type(dtype: T.DataType) -> T.DataType:
    """The type ``SUM`` returns for an input of ``dtype``."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return dtype


def row_hash(cols: list[str]) -> Column:
    """Deterministic 64-bit hash of some columns (stable across task retries)."""
    return F.xxhash64(*[F.col(c) for c in cols])


def salt_hash(cols: list[str]) -> Column:
    """Hash for picking a salt: the columns plus the task's partition index.

    Identical rows (copies) hash alike by content alone; adding the input
    partition index spreads copies that sit in different input splits.  The
    index is fixed for a task, so a retried task picks the same salts.
    """
    return F.xxhash64(*[F.col(c) for c in cols], F.spark_partition_id())
