"""Bucketed tables, registered partitions, large as-of reads and hot-key sketches."""

from __future__ import annotations

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from submart.operators import joins
from submart.operators.joins import MEASURED, hot_buckets, key_bucket, lookup_join, measured_broadcast, salted_left_join
from submart.plans import Layout, run_all
from submart.plans import driver_queries as q
from submart.plans.pipelines import enrichment_result, enrichment_specs, profile_result, profile_specs
from submart.session import shared_dir
from submart.sources import overwrite_partitions, read_table, readers, scd4_asof
from submart.sources.sinks import MODE_CONF
from submart.specs import RunContext, TargetSpec

SF = "/root/testdata/sf0.001"
D = dt.date
RUN = D(2024, 1, 15)
T0 = dt.datetime(2024, 1, 1)


def bag(df):
    return collections.Counter(repr(r.asDict(recursive=True)) for r in df.collect())


def tree(df) -> list[str]:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [line.strip(" :|+-") for line in text.split("\n\n")[0].splitlines()]


def final_tree(df) -> list[str]:
    """The plan that ran, after AQE."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return [line.strip(" :|+-") for line in execution.executedPlan().toString().split("== Initial Plan ==")[0].splitlines()]


# ---- as-of reads of large histories

@pytest.mark.parametrize("groups", [1, 4096])
def test_newest_versions_equal_the_window(spark, groups):
    """Also where the filter has so few bits that it passes most rows."""
    hist = spark.range(60_000).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 9000).cast("int").alias("k"),
        (F.col("id") % 3).cast("string").alias("k2"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 700, 0, 0)").alias("ts"),
        F.concat(F.lit("v"), F.col("id") % 50).alias("v"), F.lit(1).alias("__n"))
    spark.conf.set(readers.FILTER_GROUPS_CONF, str(groups))
    try:
        for keys in (["k"], ["k", "k2"]):
            large = scd4_asof(hist, keys, "ts", RUN, skew_safe=True, hot_key_rows=100)
            small = scd4_asof(hist, keys, "ts", RUN, skew_safe=False)
            assert large.columns == small.columns and bag(large) == bag(small)
    finally:
        spark.conf.unset(readers.FILTER_GROUPS_CONF)


def test_large_asof_plan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = tree(q.scd4_asof_latest_large_q(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = "\n".join(lines)
    assert "Window" not in text and "LeftSemi" in "\n".join(tree_details(spark)) and "TakeOrdered" not in text
    assert not hasattr(readers, "_asof_rank_salted")


def tree_details(spark) -> list[str]:
    df = q.scd4_asof_latest_large_q(spark, SF)
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_filter_drops_older_versions_before_the_shuffle(spark):
    hist = spark.range(40_000).select((F.col("id") % 500).alias("k"), F.expr(
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, cast(id as decimal(18,6)))").alias("ts"))
    newest = hist.groupBy("k").agg(F.max("ts").alias("t"))
    bits = readers.newest_filter(newest, F.xxhash64("k", "t"), 1 << 12)
    assert bits.count() <= 1 << 12
    assert bits.select(F.sum(F.aggregate("__bits", F.lit(0).cast("bigint"), lambda a, b: a + F.bit_count(b)))).first()[0] <= 500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = readers.newest_versions(hist, ["k"], "ts")
        execution = out._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        shuffled = []
        walk(execution.executedPlan().executedPlan(), shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.count() == 500
    # each split sends its keys' newest times; of the 40,000 wide rows only the 500 go
    assert shuffled and max(shuffled) < 20_000


def walk(node, rows):
    """Records written by every shuffle under a finished adaptive plan."""
    if node.nodeName() == "Exchange":
        rows.append(node.metrics().apply("shuffleRecordsWritten").value())
    if "QueryStage" in node.nodeName():
        walk(node.plan(), rows)
    for i in range(node.children().size()):
        walk(node.children().apply(i), rows)


# ---- hot keys from stored columns

def test_hot_buckets(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 == 1, F.lit(None))
                                    .otherwise(F.col("id") % 997).cast("int").alias("k"), F.col("id").alias("other"))
    found = hot_buckets(df, {"k": None, "other": None}, hot_key_rows=1000)
    assert found["other"].count() == 0
    got = found["k"].collect()
    n7 = df.where("k = 7").count()
    want = spark.range(1).select(key_bucket(F.lit(7).cast("int"))).first()[0]
    assert [(r[joins.HK], r[joins.NB]) for r in got] == [(want, -(-n7 // 1000))]


def test_bucket_salted_join(spark, monkeypatch):
    left = spark.createDataFrame([(str(i % 7) if i % 3 else None if i % 2 else "3", i) for i in range(900)], "lk string, v int")
    right = spark.createDataFrame([(i % 5, f"w{i}") for i in range(10)], "rk bigint, w string")
    plain = left.join(right, F.col("lk").try_cast("bigint") == F.col("rk"), "left")
    for buckets in (1 << 20, 2):                            # also where hot and cold keys share a bucket
        monkeypatch.setattr(joins, "KEY_BUCKETS", buckets)
        common = joins.common_key_type(left, right, "lk", "rk")
        hot = hot_buckets(left, {"lk": common}, hot_key_rows=50)["lk"]
        assert hot.count() >= 1
        assert bag(salted_left_join(left, right, "lk", "rk", buckets=hot)) == bag(plain)


def test_measured_broadcast_asks_no_job(spark, tmp_path):
    spark.range(100).withColumn("t", F.lit("x")).write.parquet(f"{tmp_path}/small")
    small = spark.read.parquet(f"{tmp_path}/small")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
    try:
        assert measured_broadcast(small)
        big = spark.range(1000).select(F.col("id").alias("k"))
        out = lookup_join(big, small.withColumnRenamed("id", "i"), "k", "i", small=MEASURED)
        assert "BroadcastHashJoin" in "\n".join(final_tree(out)) and out.where("t is not null").count() == 100
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1b")
        assert not measured_broadcast(small)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark):
    lay = Layout(root=shared_dir(spark, "stored"))
    for name, make in (("vw_usge", fx.usage), ("vw_subs_hist", fx.subs_hist), ("vw_subs_stts_hist", fx.stts_hist),
                       ("vw_cust_type_hist", fx.cust_type_hist), ("vw_acct_hist", fx.acct_hist), ("vw_cust_hist", fx.cust_hist)):
        make(spark).write.parquet(lay.where(name))
        if name.endswith("_hist"):
            make(spark).write.parquet(lay.where(name[:-5] + "_active"))
    return lay


def test_forced_large_plans_rank_no_history(spark, stored):
    """With no broadcast and every key hot, P2 and P3 give the same rows; their histories are read without a window."""
    ctx = RunContext(fx.RUN_DATE, fx.CURRENT_DATE)
    run_all(spark, stored, ctx)
    sources2, sources3 = enrichment_specs(stored)[0], profile_specs(stored)[0]
    want2, want3 = bag(enrichment_result(spark, sources2, ctx)), bag(profile_result(spark, sources3, ctx))
    spark.conf.set("submart.broadcast.maxRows", "0")
    spark.conf.set("submart.skew.hotKeyRows", "1")
    try:
        p2, p3 = enrichment_result(spark, sources2, ctx), profile_result(spark, sources3, ctx)
        assert not [line for line in tree(p2) + tree(p3) if line.startswith("Window")]
        assert bag(p2) == want2 and bag(p3) == want3
        spark.conf.unset("submart.skew.hotKeyRows")
        p2, p3 = enrichment_result(spark, sources2, ctx), profile_result(spark, sources3, ctx)
        windows = lambda df: sum(line.startswith("Window ") for line in tree(df))
        assert (windows(p2), windows(p3)) == (3, 3)       # one window per history
        assert bag(p2) == want2 and bag(p3) == want3
    finally:
        spark.conf.unset("submart.broadcast.maxRows")
        spark.conf.unset("submart.skew.hotKeyRows")


def test_enrichment_plans_without_a_job(spark, stored):
    sources, _ = enrichment_specs(stored)
    for spec in sources.values():
        readers.stored_rows(spark, spec, RunContext(fx.RUN_DATE, fx.CURRENT_DATE))
    tracker = spark.sparkContext.statusTracker()
    schema_jobs = []
    for group, plan in (("schemas", lambda: [read_table(spark, s.hist) for s in sources.values()]),
                        ("planned", lambda: enrichment_result(spark, sources, RunContext(fx.RUN_DATE, fx.CURRENT_DATE)))):
        spark.sparkContext.setJobGroup(f"test-{group}", group)
        try:
            plan()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        schema_jobs.append(len(tracker.getJobIdsForGroup(f"test-{group}")))
    assert schema_jobs[0] == schema_jobs[1] == 3


# ---- bucketed tables

@pytest.fixture
def database(spark):
    location = shared_dir(spark, "storage-db")
    name = f"st_{location[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    before = spark.conf.get(MODE_CONF)
    spark.conf.set(MODE_CONF, "dynamic")
    yield name
    spark.conf.set(MODE_CONF, before)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_profile_over_buckets_has_no_exchange(spark, database):
    layout = q.bucketed_mart(spark, SF, database)
    q._run_jobs(spark, layout)
    sources, _ = profile_specs(layout)
    ctx = RunContext(q.RUN_DATE, q.RUN_DATE + dt.timedelta(days=30))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = profile_result(spark, sources, ctx)
        lines = tree(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [i for i, line in enumerate(lines) if line.startswith("SortMergeJoin")]
    assert len(joined) == 2                                 # enrichment and usage, by subscriber key
    exchanges = [line for line in lines[joined[0]:] if line.startswith("Exchange")]
    # what is left are the small lookups' own as-of reads and copies
    assert all(broadcast_below(lines, i) for i, line in enumerate(lines) if line.startswith("Exchange")), exchanges
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert text.count("Bucketed: true") >= 3


def broadcast_below(lines, i) -> bool:
    """Whether an exchange stands under a broadcast, that is on a lookup's side."""
    above = [line for line in lines[:i] if line.startswith(("BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin"))]
    return bool(above) and above[-1].startswith("BroadcastExchange")


def test_bucketed_target_is_restated(spark, database):
    target = TargetSpec(name="t", location=f"{database}.t", partition_columns=("day",), keys=("k",), buckets=4)
    rows = lambda n, day: spark.range(50).select(F.col("id").alias("k"), F.lit(n).alias("n"), F.lit(day).alias("day"))
    overwrite_partitions(rows(1, "a").unionByName(rows(2, "b")), target)
    overwrite_partitions(rows(3, "b"), target)
    got = {(r.day, r.n): r["count"] for r in spark.table(target.location).groupBy("day", "n").count().collect()}
    assert got == {("a", 1): 50, ("b", 3): 50}
    assert spark.catalog.getTable(target.location) and any(
        c.name == "k" and c.isBucket for c in spark.catalog.listColumns(target.location))
    files = spark.table(target.location).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 8                                       # one per bucket and day


@pytest.mark.parametrize("kw", [{"location": "/x/t"}, {"location": "d.t", "keys": ()}, {"location": "d.t", "buckets": 0}])
def test_buckets_need_keys_and_a_catalog_table(kw):
    with pytest.raises(ValueError, match="buckets"):
        TargetSpec(**{"name": "t", "partition_columns": ("p",), "keys": ("k",), "buckets": 2, **kw})


# ---- partitions of a path under a catalog table

@pytest.mark.parametrize("day", ["date", "string"])
def test_path_partitions_are_registered(spark, database, day):
    location = shared_dir(spark, "reg")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, day string").withColumn("day", F.col("day").cast(day))
    plain = TargetSpec(name="t", location=location, partition_columns=("day",))
    overwrite_partitions(rows((0, "2024-01-01")), plain)    # there before the table
    target = TargetSpec(name="t", location=location, partition_columns=("day",), catalog_table=f"{database}.reg")
    for write in (rows((1, "2024-01-02")), rows((2, "2024-01-03"), (3, "2024-01-02")), rows((4, None)), rows()):
        overwrite_partitions(write, target)
    got = sorted((r.k, str(r.day)) for r in spark.table(target.catalog_table).collect())
    assert got == [(0, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-02"), (4, "None")]
    # the control: a write that registers nothing is not seen
    overwrite_partitions(rows((9, "2024-02-01")), plain)
    spark.catalog.refreshTable(target.catalog_table)
    assert spark.table(target.catalog_table).count() == 4


def test_partition_values_are_quoted(spark, database):
    location = shared_dir(spark, "quoted")
    target = TargetSpec(name="t", location=location, partition_columns=("p",), catalog_table=f"{database}.quoted")
    for value in ("a", "it's", "back\\slash", "x=y/z", ""):
        overwrite_partitions(spark.createDataFrame([(1, value)], "k int, p string"), target)
    assert sorted(str(r.p) for r in spark.table(target.catalog_table).collect()) == sorted(
        ["a", "it's", "back\\slash", "x=y/z", "None"])      # an empty value is stored as NULL


def test_jobs_register_their_targets(spark, stored, database):
    layout = Layout(root=stored.root, register_in=database)
    for days in (0, 1):
        run_all(spark, layout, RunContext(fx.RUN_DATE + dt.timedelta(days=days), fx.CURRENT_DATE))
        for name in ("usge_dly_aggr", "subs_enriched", "subs_profile"):
            assert spark.table(f"{database}.{name}").count() == read_table(spark, layout.where(name)).count()
    assert {r.run_date for r in spark.table(f"{database}.subs_profile").select("run_date").collect()} >= {"2024-01-25", "2024-01-26"}


def test_layout_settings():
    with pytest.raises(ValueError):
        Layout(root="/x", buckets=4)
    with pytest.raises(ValueError):
        Layout(database="d", register_in="e")
