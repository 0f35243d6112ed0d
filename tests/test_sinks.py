"""Sink fixtures (FIXTURES.md §4): dynamic overwrite and whole-table writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from submart.session import shared_dir
from submart.sources import overwrite_partitions, read_table, write_table
from submart.specs import TargetSpec

D = dt.date


def target(location, **kw):
    return TargetSpec(name="t", location=location, partition_columns=("evnt_strt",),
                      columns=("subs_key", "n", "evnt_strt"), keys=("subs_key",), **kw)


def frame(spark, rows):
    return spark.createDataFrame(rows, "subs_key int, n bigint, aggr_grain date")


def read(spark, location):
    return sorted((r.subs_key, r.n, r.evnt_strt) for r in read_table(spark, location).collect())


def test_dynamic_overwrite_keeps_other_partitions(spark):
    loc = shared_dir(spark, "dyn")
    overwrite_partitions(frame(spark, [(1, 1, D(2024, 1, 1)), (1, 2, D(2024, 1, 2))]), target(loc))
    overwrite_partitions(frame(spark, [(2, 9, D(2024, 1, 2))]), target(loc))
    assert read(spark, loc) == [(1, 1, D(2024, 1, 1)), (2, 9, D(2024, 1, 2))]


def test_static_overwrite_loses_partitions(spark):
    # why every write sets the dynamic mode itself
    loc = shared_dir(spark, "static")
    first = frame(spark, [(1, 1, D(2024, 1, 1)), (1, 2, D(2024, 1, 2))]).toDF("subs_key", "n", "evnt_strt")
    first.write.partitionBy("evnt_strt").parquet(loc)
    second = frame(spark, [(2, 9, D(2024, 1, 2))]).toDF("subs_key", "n", "evnt_strt")
    (second.write.mode("overwrite").option("partitionOverwriteMode", "static")
           .partitionBy("evnt_strt").parquet(loc))
    assert read(spark, loc) == [(2, 9, D(2024, 1, 2))]


def test_empty_result_changes_nothing(spark):
    loc = shared_dir(spark, "empty")
    overwrite_partitions(frame(spark, [(1, 1, D(2024, 1, 1))]), target(loc))
    overwrite_partitions(frame(spark, []), target(loc))
    assert read(spark, loc) == [(1, 1, D(2024, 1, 1))]


def test_null_partition_round_trip(spark):
    import os
    loc = shared_dir(spark, "nullpart")
    overwrite_partitions(frame(spark, [(1, 1, None), (2, 2, D(2024, 1, 1))]), target(loc))
    path = loc[len("file:"):] if loc.startswith("file:") else loc
    assert "evnt_strt=__HIVE_DEFAULT_PARTITION__" in os.listdir(path)
    assert read(spark, loc) == [(1, 1, None), (2, 2, D(2024, 1, 1))]


def test_rerun_is_idempotent(spark):
    loc = shared_dir(spark, "rerun")
    rows = [(1, 1, D(2024, 1, 1)), (2, 2, D(2024, 1, 1)), (3, 3, D(2024, 1, 2))]
    overwrite_partitions(frame(spark, rows), target(loc, files_per_partition=3))
    overwrite_partitions(frame(spark, rows), target(loc, files_per_partition=3))
    assert read(spark, loc) == sorted(rows)


def test_position_matching_renames(spark):
    loc = shared_dir(spark, "position")
    overwrite_partitions(frame(spark, [(1, 5, D(2024, 1, 3))]), target(loc))
    back = read_table(spark, loc)
    assert back.columns == ["subs_key", "n", "evnt_strt"]


def test_insert_into_catalog_table_by_position(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.sql("drop table if exists sink_pos")
    spark.sql("create table sink_pos (subs_key int, n bigint, evnt_strt date) "
              "using parquet partitioned by (evnt_strt)")
    t = TargetSpec(name="sink_pos", location="sink_pos", partition_columns=("evnt_strt",),
                   columns=("subs_key", "n", "evnt_strt"))
    overwrite_partitions(frame(spark, [(1, 1, D(2024, 1, 1)), (1, 2, D(2024, 1, 2))]), t)
    # the result's last column is called aggr_grain; it lands in evnt_strt
    overwrite_partitions(frame(spark, [(2, 9, D(2024, 1, 2))]), t)
    got = sorted(tuple(r) for r in spark.table("sink_pos").collect())
    assert got == [(1, 1, D(2024, 1, 1)), (2, 9, D(2024, 1, 2))]
    # the session's own setting is restored after the insert
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_files_per_partition_bounds_files(spark):
    import glob
    loc = shared_dir(spark, "files")
    rows = [(k, k, D(2024, 1, 1 + k % 3)) for k in range(300)]
    overwrite_partitions(frame(spark, rows).repartition(8), target(loc, files_per_partition=2))
    path = loc[len("file:"):] if loc.startswith("file:") else loc
    for part in glob.glob(f"{path}/evnt_strt=*"):
        assert 1 <= len(glob.glob(f"{part}/*.parquet")) <= 2
    assert len(read(spark, loc)) == 300


def test_whole_table_overwrite(spark):
    loc = shared_dir(spark, "whole")
    write_table(spark.range(3).withColumn("name", F.lit("a")), loc)
    write_table(spark.range(2).withColumn("name", F.lit("b")), loc, "overwrite")
    assert sorted(tuple(r) for r in read_table(spark, loc).collect()) == [(0, "b"), (1, "b")]
    write_table(spark.range(1).withColumn("name", F.lit("c")), loc, "append")
    assert read_table(spark, loc).count() == 3


def test_conform_rejects_wrong_width(spark):
    import pytest
    with pytest.raises(ValueError):
        overwrite_partitions(spark.range(1), target(shared_dir(spark, "bad")))


def test_rebalance_spreads_by_partition_value(spark):
    import glob
    loc = shared_dir(spark, "rebalance")
    rows = [(k, k, D(2024, 1, 1 + k % 3)) for k in range(3000)]
    t = target(loc, rebalance=True)
    df = frame(spark, rows).repartition(8)
    from submart.sources.sinks import _spread, conform
    plan = _spread(conform(df, t), t)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    overwrite_partitions(df, t)
    path = loc[len("file:"):] if loc.startswith("file:") else loc
    assert len(glob.glob(f"{path}/evnt_strt=*")) == 3
    assert len(read(spark, loc)) == 3000
