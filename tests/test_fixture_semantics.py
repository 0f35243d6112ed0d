"""The hand-made fixture (FIXTURES.md §3): boundaries, ties, NULLs, unknowns."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from submart.functions.dates import window_start
from submart.operators import aggregate_usage, build_profile, enrich_subscribers
from submart.sources import scd1_window, scd4_asof, snapshot


def asof(df, key):
    return scd4_asof(df, [key], "ecf_nsrt_ts", fx.RUN_DATE)


def test_asof_latest_version(spark):
    got = {(r.subs_key, r.subs_stts_key)
           for r in asof(fx.subs_hist(spark), "subs_key").collect()}
    assert got == fx.EXPECTED_ASOF_SUBS


def test_asof_keeps_rank_column_and_ties(spark):
    df = asof(fx.acct_hist(spark), "acct_key")
    assert "rnk" in df.columns
    got = sorted((r.acct_key, r.acct_id, r.rnk) for r in df.collect())
    assert got == [(1000, "A1000", 1), (1001, "A1001", 1), (1001, "A1001B", 1)]


def test_asof_tie_break_keeps_one(spark):
    df = scd4_asof(fx.acct_hist(spark), ["acct_key"], "ecf_nsrt_ts", fx.RUN_DATE,
                   tie_break=["acct_id"])
    got = sorted((r.acct_key, r.acct_id) for r in df.collect())
    assert got == [(1000, "A1000"), (1001, "A1001B")]


def test_asof_null_keys_form_one_group(spark):
    df = spark.createDataFrame(
        [(None, "x", fx.ts("2024-01-01 00:00:00")), (None, "y", fx.ts("2024-01-02 00:00:00"))],
        "k int, v string, ecf_nsrt_ts timestamp")
    got = [(r.k, r.v) for r in scd4_asof(df, ["k"], "ecf_nsrt_ts", fx.RUN_DATE).collect()]
    assert got == [(None, "y")]


def test_asof_compound_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", fx.ts("2024-01-01 00:00:00")), (1, 1, "b", fx.ts("2024-01-03 00:00:00")),
         (1, 2, "c", fx.ts("2024-01-02 00:00:00"))],
        "k1 int, k2 int, v string, ecf_nsrt_ts timestamp")
    got = sorted(r.v for r in scd4_asof(df, ["k1", "k2"], "ecf_nsrt_ts", fx.RUN_DATE).collect())
    assert got == ["b", "c"]


def test_future_run_date_reads_everything(spark):
    df = scd4_asof(fx.subs_hist(spark), ["subs_key"], "ecf_nsrt_ts", dt.date(2030, 1, 1))
    got = {(r.subs_key, r.subs_stts_key) for r in df.collect()}
    assert got == {(1, 12), (2, 10), (3, 99), (5, 13)}


def windowed_usage(spark, start_align=False):
    days = fx.WINDOW_DAYS
    if start_align:
        days = (fx.RUN_DATE - window_start(fx.RUN_DATE, days, True)).days
    return scd1_window(fx.usage(spark), "evnt_strt_ts", fx.RUN_DATE, days)


def test_window_bounds(spark):
    got = sorted(r.evnt_strt_ts for r in windowed_usage(spark).collect())
    assert fx.ts("2023-12-16 00:00:00") in got            # exactly 40 days back: kept
    assert fx.ts("2023-12-15 23:59:59") not in got        # one second older: dropped
    assert fx.ts("2024-01-26 09:00:00") in got            # after the run date: kept
    assert None not in got                                # NULL time: dropped


def test_window_until(spark):
    df = scd1_window(fx.usage(spark), "evnt_strt_ts", fx.RUN_DATE, fx.WINDOW_DAYS,
                     until=fx.RUN_DATE)
    assert fx.ts("2024-01-26 09:00:00") not in [r.evnt_strt_ts for r in df.collect()]


def test_daily_usage(spark):
    df = aggregate_usage(windowed_usage(spark), "DAILY")
    assert df.columns == ["subs_key", "dwld_vlum_qty", "upld_vlum_qty", "actl_data_vlum_qty",
                          "data_rnd_unit_qty", "aggr_grain"]
    assert dict(df.dtypes)["aggr_grain"] == "date"
    assert dict(df.dtypes)["dwld_vlum_qty"] == "bigint"
    assert fx.sorted_rows(df) == fx.as_sorted(fx.EXPECTED_DAILY)


def test_monthly_usage_unaligned(spark):
    df = aggregate_usage(windowed_usage(spark), "MONTHLY")
    assert dict(df.dtypes)["aggr_grain"] == "string"
    assert fx.sorted_rows(df) == fx.as_sorted(fx.EXPECTED_MONTHLY)


def test_monthly_usage_aligned(spark):
    df = aggregate_usage(windowed_usage(spark, start_align=True), "MONTHLY")
    assert fx.sorted_rows(df) == fx.as_sorted(fx.EXPECTED_MONTHLY_ALIGNED)


def test_daily_sums_equal_monthly_sums(spark):
    daily = aggregate_usage(fx.usage(spark), "DAILY")
    monthly = aggregate_usage(fx.usage(spark), "MONTHLY")
    cols = ["dwld_vlum_qty", "upld_vlum_qty", "actl_data_vlum_qty", "data_rnd_unit_qty"]
    tot = lambda d: d.agg(*[F.sum(c) for c in cols]).first()
    assert tuple(tot(daily)) == tuple(tot(monthly))


def test_unknown_grain_fails(spark):
    with pytest.raises(ValueError):
        aggregate_usage(fx.usage(spark), "YEARLY")


def enriched(spark):
    return enrich_subscribers(asof(fx.subs_hist(spark), "subs_key"),
                              asof(fx.stts_hist(spark), "subs_stts_key"),
                              asof(fx.cust_type_hist(spark), "cust_type_key"), fx.RUN_DATE)


@pytest.mark.parametrize("small", [True, False])
def test_enrichment(spark, small):
    df = enrich_subscribers(asof(fx.subs_hist(spark), "subs_key"),
                            asof(fx.stts_hist(spark), "subs_stts_key"),
                            asof(fx.cust_type_hist(spark), "cust_type_key"), fx.RUN_DATE,
                            stts_small=small, cust_type_small=small)
    assert df.columns == ["subs_key", "subs_stts_key", "subs_stts_ds", "cust_type_key",
                          "cust_type_ds", "run_date"]
    assert fx.sorted_rows(df) == fx.as_sorted(fx.EXPECTED_ENRICHED)


def profile(spark, mode, small=None):
    stored = enriched(spark).withColumn("subs_key", F.col("subs_key").cast("string"))
    usage = aggregate_usage(windowed_usage(spark), "DAILY").withColumnRenamed("aggr_grain",
                                                                             "evnt_strt")
    return build_profile(asof(fx.subs_hist(spark), "subs_key"),
                         snapshot(stored, "run_date", fx.RUN_DATE),
                         asof(fx.acct_hist(spark), "acct_key"),
                         asof(fx.cust_hist(spark), "cust_key"),
                         usage, fx.RUN_DATE, mode=mode, acct_small=small, cust_small=small)


@pytest.mark.parametrize("small", [True, False])
def test_profile_as_written(spark, small):
    df = profile(spark, "as_written", small)
    assert len(df.columns) == 29 and df.columns[-1] == "run_date"
    assert fx.sorted_rows(df, fx.PROFILE_CHECKED) == fx.as_sorted(fx.EXPECTED_AS_WRITTEN)


@pytest.mark.parametrize("small", [True, False])
def test_profile_per_subscriber(spark, small):
    df = profile(spark, "per_subscriber", small)
    assert fx.sorted_rows(df, fx.PROFILE_CHECKED) == fx.as_sorted(fx.EXPECTED_PER_SUBSCRIBER)


def test_profile_columns_and_renames(spark):
    from submart.operators.profile import PROFILE_COLUMNS
    df = profile(spark, "as_written")
    assert tuple(df.columns) == PROFILE_COLUMNS
    row = df.where("subs_key = 1").first()
    assert row.subs_prim_acct_key == row.prim_acct_key == 1000
    assert row.subs_stts_rsn_key == row.subs_stts_key == 11
    assert row.run_date == "2024-01-25"


def test_profile_sums_agree_when_tie_free(spark):
    a = profile(spark, "as_written").where("subs_key <> 2")
    b = profile(spark, "per_subscriber").where("subs_key <> 2")
    tot = lambda d: d.agg(F.sum("dwld_vlum_qty"), F.sum("data_rnd_unit_qty")).first()  # noqa
    assert tuple(tot(a)) == tuple(tot(b))


def test_bad_key_text_does_not_fail(spark):
    stored = enriched(spark).withColumn(
        "subs_key", F.when(F.col("subs_key") == 1, F.lit("abc"))
                     .otherwise(F.col("subs_key").cast("string")))
    df = build_profile(asof(fx.subs_hist(spark), "subs_key"), stored,
                       asof(fx.acct_hist(spark), "acct_key"), asof(fx.cust_hist(spark), "cust_key"),
                       aggregate_usage(fx.usage(spark)), fx.RUN_DATE, mode="per_subscriber")
    row = df.where("subs_key = 1").first()
    assert row.subs_stts_ds is None and row.cust_type_ds is None
