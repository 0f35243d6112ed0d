"""The same rows and columns on both sides of every size switch."""

from __future__ import annotations

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import duck
from submart.operators.joins import fits_broadcast, lookup_join, salted_left_join
from submart.operators.profile import build_profile
from submart.plans import driver_queries as q
from submart.plans.cli import parser
from submart.plans.oracle import ORACLE_SQL
from submart.sources import read_source, scd4_asof
from submart.sources.sinks import MODE_CONF, overwrite_partitions
from submart.specs import RunContext, ScdKind, SourceSpec, TargetSpec

RUN = dt.date(2024, 1, 15)
T0 = dt.datetime(2024, 1, 1)


def bag(df):
    return collections.Counter(repr(r.asDict(recursive=True)) for r in df.collect())


def both_sides(hist, **kw):
    small = scd4_asof(hist, ["k"], "ts", RUN, skew_safe=False, **kw)
    large = scd4_asof(hist, ["k"], "ts", RUN, skew_safe=True, hot_key_rows=2, **kw)
    counted = scd4_asof(hist, ["k"], "ts", RUN, hot_key_rows=2, rows=10**9, **kw)
    assert small.columns == large.columns == counted.columns
    assert bag(small) == bag(large) == bag(counted)
    return small


def test_tie_break_picks_one_row_at_every_size(spark):
    rows = [(1, T0, 5, w) for w in "habcz"] + [(None, T0, 1, "x"), (None, T0, 1, "y"), (2, T0, None, "n")]
    hist = spark.createDataFrame(rows, "k int, ts timestamp, b int, w string")
    got = {r.k: r.w for r in both_sides(hist, tie_break=["b"]).collect()}
    assert got == {1: "z", None: "y", 2: "n"}


def test_map_columns_at_every_size(spark):
    rows = [(1, T0, {"a": i}) for i in range(6)] + [(2, T0, None)]
    hist = spark.createDataFrame(rows, "k int, ts timestamp, m map<string,int>")
    assert both_sides(hist).count() == 7
    assert both_sides(hist.dropDuplicates(["k", "ts"]), tie_break=["k"]).count() == 2


def test_a_rank_column_of_the_history_is_replaced(spark):
    hist = spark.createDataFrame([(1, T0, 9)] * 4, "k int, ts timestamp, rnk int")
    got = both_sides(hist)
    assert got.columns == ["k", "ts", "rnk"] and {r.rnk for r in got.collect()} == {1}


@pytest.mark.parametrize("rk", ["int", "bigint", "double", "decimal(6,0)"])
def test_salted_join_of_text_and_number(spark, rk):
    left = spark.createDataFrame([("1", i) for i in range(5)] + [("01", i) for i in range(5)]
                                 + [("x", 0), (None, 0), ("2", 0)], "lk string, v int")
    right = spark.createDataFrame([(1, "a"), (3, "b")], "rk int, w string").withColumn("rk", F.col("rk").cast(rk))
    small = lookup_join(left, right, "lk", "rk", small=True)
    large = salted_left_join(left, right, "lk", "rk", hot_key_rows=2, max_salt=4)
    assert small.columns == large.columns
    assert bag(small) == bag(large)
    assert sum(r.w == "a" for r in large.collect()) == 10 and large.count() == 13


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(40).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    spark.conf.set("submart.broadcast.maxBytes", "100000")
    try:
        assert not fits_broadcast(wide) and fits_broadcast(wide.select("id"))
    finally:
        spark.conf.unset("submart.broadcast.maxBytes")


def test_rows_are_deduplicated_before_columns_go(spark, tmp_path):
    rows = [(1, 5, "a"), (2, 5, "a"), (3, 5, "a"), (3, 5, "a")]
    spark.createDataFrame(rows, "id int, mb int, t string").write.parquet(f"{tmp_path}/u")
    spec = SourceSpec(name="u", kind=ScdKind.CURRENT_SCD1, location=f"{tmp_path}/u", columns=("mb", "t"),
                      drop_duplicates=True)
    assert read_source(spark, spec, RunContext(RUN, RUN)).count() == 3


@pytest.mark.parametrize("copies", [1, 200])
def test_tied_copies_meet_as_one_row(spark, copies):
    from submart.operators.profile import ACCT_COLUMNS, CUST_COLUMNS, SUBS_COLUMNS
    from submart.operators.usage import OUTPUT_MEASURES

    def frame(columns, values, n=1):
        return spark.createDataFrame([tuple(values.get(c) for c in columns)] * n,
                                     ", ".join(f"{c} {'int' if c.endswith('key') else 'string'}" for c in columns))

    subs = frame(SUBS_COLUMNS, {"subs_key": 7, "subs_id": "s", "prim_acct_key": 1, "cust_key": 2}, copies)
    enriched = spark.createDataFrame([("7", "ACT", 1, "RES")] * copies,
                                     "subs_key string, subs_stts_ds string, subs_stts_key int, cust_type_ds string")
    acct, cust = frame(ACCT_COLUMNS, {"acct_key": 1}), frame(CUST_COLUMNS, {"cust_key": 2})
    usage = spark.createDataFrame([(7, 3, 1, 1, 1), (7, 3, 1, 1, 1), (7, 5, 1, 1, 1)],
                                  "subs_key int, " + ", ".join(f"{m} bigint" for m in OUTPUT_MEASURES))
    out = build_profile(subs, enriched, acct, cust, usage, RUN)
    assert sorted(r[OUTPUT_MEASURES[0]] for r in out.collect()) == [5 * copies**2, 6 * copies**2]
    # no join puts out more than a row per distinct subscriber and usage tuple
    execution = out._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    rows = []
    walk_all(execution.executedPlan().executedPlan(), rows)
    assert rows and max(rows) <= 2


def walk_all(node, rows):
    """Output rows of every join under a finished adaptive plan."""
    name = node.nodeName()
    if "Join" in name:
        rows.append(node.metrics().apply("numOutputRows").value())
    if "QueryStage" in name:
        walk_all(node.plan(), rows)
    for i in range(node.children().size()):
        walk_all(node.children().apply(i), rows)


def test_snapshot_query_shows_a_static_overwrite(spark, monkeypatch):
    """With a static overwrite the first date is lost, and the query's rows differ from its oracle."""
    def static(df, target):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *target.partition_columns).parquet(target.location)

    sf = "/root/testdata/sf0.001"
    want = duck(sf).sql(f"select count(*) from ({ORACLE_SQL['snapshot_write_read']}) q").fetchall()[0][0]
    assert q.snapshot_write_read_q(spark, sf).count() == want
    monkeypatch.setattr(q, "overwrite_partitions", static)
    assert q.snapshot_write_read_q(spark, sf).count() == want // 2


def test_insert_needs_the_dynamic_mode(spark):
    df = spark.createDataFrame([(1, "a")], "v int, p string")
    target = TargetSpec(name="t", location="default.insert_mode_test", partition_columns=("p",))
    before = spark.conf.get(MODE_CONF)
    spark.conf.set(MODE_CONF, "static")
    try:
        overwrite_partitions(df, target)
        with pytest.raises(RuntimeError, match="dynamic"):
            overwrite_partitions(df, target)
    finally:
        spark.conf.set(MODE_CONF, before)
        spark.sql("DROP TABLE IF EXISTS default.insert_mode_test")


def test_command_line_settings():
    args = parser().parse_args(["usage", "2024-01-25", "--root", "/x", "--window-days", "7", "--grain", "monthly",
                                "--drop-duplicates", "--partition-column", "day", "--usage-from", "2024-01-01"])
    assert (args.window_days, args.grain, args.drop_duplicates, args.partition_column, args.usage_from) == (
        7, "MONTHLY", True, "day", dt.date(2024, 1, 1))
