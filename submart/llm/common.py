"""Helpers shared by the operators: tables, staging, fixed-size id filters."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from submart.session import shared_dir


#: rows of text that go to a Python worker at once: texts can be long
BATCH_ROWS = 1000
#: large arrays go back to the system when freed, so a worker that is reused stays small
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "262144",
              "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Spark removes the shuffle files of a query that has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep them small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for k, v in WORKER_ENV.items():
        env.setdefault(k, v)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage, so a lost executor costs one read and never the
    work above; the folder is the one ``spark.checkpoint.dir`` names.
    With ``free`` the shuffle files of the write go when it is done, not when
    the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, name)}/{uuid.uuid4().hex[:8]}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    if free:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(column):
    """A-Z lower-cased; every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_remainder(column, modulus: int):
    """crc32 of the id written as decimal text, modulo ``modulus``."""
    return F.pmod(F.crc32(column.cast("string")), F.lit(modulus)).cast("int")


def first_rows(rows: DataFrame, key: str, n: int) -> list:
    """The ``n`` rows with the smallest ``key``, as a list; ties by all columns.

    The key alone is ranked first, so tasks send the driver n keys each and not
    n rows; the rows up to the last key follow.
    """
    keys = rows.select(key).orderBy(key).limit(n).agg(F.max(key)).first()[0]
    return [] if keys is None else rows.filter(F.col(key) <= keys).orderBy(key, *rows.columns).limit(n).collect()


class IdFilter:
    """A bitmap of hashed ids of one fixed size, whatever the number of ids.

    It only says which rows surely need no join.  With more ids than bits it
    passes more rows; it never loses one.
    """

    def __init__(self, ids: DataFrame, column: str, log2_bits: int = 22):
        self.log2_bits = log2_bits
        spark = ids.sparkSession
        bit = self.bit(F.col(column))
        words = (ids.select(bit.alias("b")).groupBy((F.col("b") / 64).cast("int").alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v")).collect())
        bits = np.zeros(1 << (log2_bits - 6), dtype=np.int64)
        for row in words:
            bits[row["w"]] = row["v"]
        self._bits = spark.sparkContext.broadcast(bits)

    def bit(self, column):
        """The bit of an id, as a column."""
        return F.pmod(F.xxhash64(column.cast("bigint")), F.lit(1 << self.log2_bits)).cast("bigint")

    @property
    def hits(self):
        """A function of an array of bits, for workers: which are set."""
        bits = self._bits

        def hits(bit: np.ndarray) -> np.ndarray:
            bit = bit.astype(np.int64)
            return (bits.value[bit >> 6] >> (bit & 63)) & 1 == 1

        return hits

    def may_have(self, column):
        """Whether the id may be among the ids (never wrong when false)."""
        hits = self.hits

        @F.pandas_udf("boolean")
        def hit(bit):
            import pandas as pd
            return pd.Series(hits(bit.to_numpy()))

        return hit(self.bit(column))
