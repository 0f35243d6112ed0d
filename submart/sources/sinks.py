"""Writing results: idempotent partition overwrite and whole-table writes.

K1 replaces exactly the partitions present in a result and leaves the rest,
so re-running a run date (or a trailing window of days) restates those days
and nothing else.  Spark's commit protocol stages the files and moves them
into place at job commit, so a lost executor only costs a task retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import row_hash
from ..specs import TargetSpec


def _is_path(location: str) -> bool:
    return "/" in location or ":" in location


def conform(df: DataFrame, target: TargetSpec) -> DataFrame:
    """Match a result to the target's columns by position (partition last)."""
    if target.columns is None:
        missing = [c for c in target.partition_columns if c not in df.columns]
        if missing:
            raise ValueError(f"{target.name}: result lacks partition columns {missing}")
        rest = [c for c in df.columns if c not in target.partition_columns]
        return df.select(*rest, *target.partition_columns)
    if len(df.columns) != len(target.columns):
        raise ValueError(f"{target.name}: result has {len(df.columns)} columns, "
                         f"target has {len(target.columns)}")
    return df.toDF(*target.columns)


def _spread(df: DataFrame, target: TargetSpec) -> DataFrame:
    """Group each partition value's rows into ``files_per_partition`` tasks.

    Without it every task writes a file into every partition value it holds
    (tasks x days small files); with it one value never serialises on one
    task either.
    """
    if target.buckets:
        # a task per bucket: one file of it in each partition value
        return df.repartition(int(target.buckets), *[F.col(k) for k in target.keys])
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    if target.rebalance and aqe:
        return df.hint("rebalance", *target.partition_columns)
    if target.files_per_partition is None:
        return df
    parts = [F.col(c) for c in target.partition_columns]
    n = int(target.files_per_partition)
    if n == 1:
        return df.repartition(*parts)
    keys = list(target.keys) or [c for c in df.columns if c not in target.partition_columns]
    return df.repartition(*parts, F.pmod(row_hash(keys), F.lit(n)))


def overwrite_partitions(df: DataFrame, target: TargetSpec) -> None:
    """K1: dynamic partition overwrite into a path or a catalog table."""
    out = _spread(conform(df, target), target)
    spark = df.sparkSession
    written = None
    if target.catalog_table:
        # the partition values written, gathered by the write itself
        written = Observation()
        out = out.observe(written, F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in target.partition_columns]))
                          .alias("parts"))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if target.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(target.max_records_per_file))
    if target.is_path:
        writer.partitionBy(*target.partition_columns).format(target.format).save(target.location)
        if written is not None:
            register_partitions(spark, target, out, [p.asDict() for p in written.get["parts"]])
        return
    if not spark.catalog.tableExists(target.location):
        if target.buckets:
            writer = writer.bucketBy(int(target.buckets), *target.keys)
        (writer.partitionBy(*target.partition_columns).format(target.format)
               .saveAsTable(target.location))
        return
    # insertInto matches by position, like INSERT OVERWRITE ... PARTITION; a
    # bucketed table keeps its buckets
    _insert_dynamic(spark, writer, target.location)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_partitions(spark: SparkSession, target: TargetSpec, df: DataFrame, written: list[dict]) -> None:
    """Make partitions written to a path known to the catalog table over it.

    Only the partitions of this write are added, in one statement; a new table
    also takes those that were there before it.  A NULL or empty partition value
    has no literal, so its folder is found by listing.
    """
    table = target.catalog_table
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = ", ".join(map(_quoted, target.partition_columns))
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {target.format} PARTITIONED BY ({parts}) "
                  f"LOCATION {_literal(target.location)}")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    elif not all(v for w in written for v in w.values()):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    elif written:
        added = " ".join("PARTITION (" + ", ".join(f"{_quoted(c)} = {_literal(v)}" for c, v in w.items()) + ")" for w in written)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)


MODE_CONF = "spark.sql.sources.partitionOverwriteMode"


def _insert_dynamic(spark: SparkSession, writer, table: str) -> None:
    """``insertInto`` with dynamic overwrite.

    Spark 4.1 ignores the per-write ``partitionOverwriteMode`` option for
    ``insertInto`` (and ``writeTo().overwritePartitions()`` refuses v1
    tables), so the session has to have the mode; ``build_session`` sets it.
    In a static session the write would clear the table, so it fails instead.
    """
    if spark.conf.get(MODE_CONF).lower() != "dynamic":
        raise RuntimeError(f"set {MODE_CONF}=dynamic to overwrite partitions of {table}")
    writer.insertInto(table, overwrite=True)


def write_table(df: DataFrame, location: str, mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """K2: write a whole table with the caller's mode."""
    writer = df.write.mode(mode).format(fmt)
    if _is_path(location):
        writer.save(location)
    else:
        writer.saveAsTable(location)


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    if _is_path(location):
        return spark.read.format(fmt).load(location)
    return spark.table(location)
