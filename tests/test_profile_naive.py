"""The profile against a literal reading of the job's query.

The naive form joins day-level usage directly and groups by the listed
columns; ``build_profile`` pre-aggregates, orders joins for partitioning,
salts hot keys and routes NULL keys around the joins.  Both must agree, on
the fixture plus NULL-key subscribers and duplicated versions.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from submart.operators import aggregate_usage, build_profile, enrich_subscribers
from submart.sources import scd1_window, scd4_asof


def naive_profile(a, b, e, f, g, run):
    j = (a.alias("a")
         .join(b.alias("b"), F.col("a.subs_key") == F.col("b.subs_key").try_cast("int"), "left")
         .join(e.alias("e"), F.col("a.prim_acct_key") == F.col("e.acct_key"), "left")
         .join(f.alias("f"), F.col("a.cust_key") == F.col("f.cust_key"), "left")
         .join(g.alias("g"), F.col("a.subs_key") == F.col("g.subs_key"), "left"))
    group = ["a.subs_key", "a.subs_id", "b.subs_stts_ds", "a.subs_stts_key", "b.cust_type_ds",
             "a.prim_rsrc_valu_txt", "a.serv_tech_nm", "a.prod_nm", "a.orig_actv_ts",
             "a.subs_stts_ts", "a.imei_id", "a.prim_acct_key", "a.cust_type_key",
             "a.prod_type_key", "a.main_bill_offr_key", "b.subs_stts_key", "e.acct_key",
             "e.acct_id", "e.acct_stts_key", "e.xtrn_id", "f.cust_key", "f.cust_id",
             "f.cust_stat_key", "g.dwld_vlum_qty", "g.upld_vlum_qty", "g.actl_data_vlum_qty",
             "g.data_rnd_unit_qty", "g.subs_key"]
    out = j.groupBy(*[F.col(c).alias(c.replace(".", "_")) for c in group]).agg(
        *[F.sum(f"g.{m}").alias(m) for m in ("dwld_vlum_qty", "upld_vlum_qty",
                                               "actl_data_vlum_qty", "data_rnd_unit_qty")])
    return out.select(F.col("a_subs_key").alias("subs_key"), F.col("b_subs_stts_ds").alias("subs_stts_ds"),
                      F.col("b_cust_type_ds").alias("cust_type_ds"), F.col("e_acct_id").alias("acct_id"),
                      F.col("f_cust_id").alias("cust_id"), "dwld_vlum_qty", "upld_vlum_qty",
                      "actl_data_vlum_qty", "data_rnd_unit_qty")


def subs_with_nulls_and_copies(spark):
    extra = spark.createDataFrame(
        [(None, "N1", 10, 100, None, None, None, None, None, None, 1000, None, None, 5000,
          fx.ts("2024-01-02 00:00:00")),
         (None, "N2", 11, 101, None, None, None, None, None, None, 1001, None, None, 5001,
          fx.ts("2024-01-02 00:00:00")),
         (6, "S6", 10, 100, None, None, None, None, None, None, 1001, None, None, 5000,
          fx.ts("2024-01-03 00:00:00")),
         (6, "S6", 10, 100, None, None, None, None, None, None, 1001, None, None, 5000,
          fx.ts("2024-01-03 00:00:00"))],
        fx.SUBS_SCHEMA)
    return fx.subs_hist(spark).unionByName(extra)


@pytest.mark.parametrize("small", [True, False])
def test_as_written_equals_naive(spark, small):
    asof = lambda df, k: scd4_asof(df, [k], "ecf_nsrt_ts", fx.RUN_DATE)
    subs = asof(subs_with_nulls_and_copies(spark), "subs_key")
    stts, ctype = asof(fx.stts_hist(spark), "subs_stts_key"), asof(fx.cust_type_hist(spark), "cust_type_key")
    acct, cust = asof(fx.acct_hist(spark), "acct_key"), asof(fx.cust_hist(spark), "cust_key")
    enriched = enrich_subscribers(subs, stts, ctype, fx.RUN_DATE).withColumn(
        "subs_key", F.col("subs_key").cast("string"))
    usage = aggregate_usage(scd1_window(fx.usage(spark), "evnt_strt_ts", fx.RUN_DATE, 40))
    usage = usage.withColumnRenamed("aggr_grain", "evnt_strt")
    spark.conf.set("submart.skew.hotKeyRows", "1")  # every repeated key counts as hot
    try:
        ours = build_profile(subs, enriched, acct, cust, usage, fx.RUN_DATE,
                             acct_small=small, cust_small=small).select(*fx.PROFILE_CHECKED)
        ours_rows = fx.sorted_rows(ours)
    finally:
        spark.conf.unset("submart.skew.hotKeyRows")
    naive = naive_profile(subs, enriched, acct, cust, usage, fx.RUN_DATE)
    assert ours_rows == fx.sorted_rows(naive)
    # the NULL-key subscribers are there, with no enrichment or usage: N1
    # once, N2 twice (its account 1001 has two tied versions)
    nulls = [r for r in ours_rows if r[0] is None]
    assert len(nulls) == 3 and all(r[1] is None and r[5] is None for r in nulls)
