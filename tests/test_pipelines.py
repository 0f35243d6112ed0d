"""P1 -> P2 -> P3 over stored fixture tables, as the jobs run them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from submart.plans import Layout, parse_context, run_all, run_usage_daily
from submart.session import shared_dir
from submart.sources import read_table
from submart.specs import RunContext

SOURCES = {
    "vw_usge": fx.usage,
    "vw_subs_hist": fx.subs_hist,
    "vw_subs_stts_hist": fx.stts_hist,
    "vw_cust_type_hist": fx.cust_type_hist,
    "vw_acct_hist": fx.acct_hist,
    "vw_cust_hist": fx.cust_hist,
}


@pytest.fixture(scope="module")
def layout(spark):
    root = shared_dir(spark, "mart")
    lay = Layout(root=root)
    for name, make in SOURCES.items():
        df = make(spark)
        df.write.parquet(lay.where(name))
        # active tables: the newest version of each, as a current-rows table
        if name.endswith("_hist"):
            df.write.parquet(lay.where(name[:-len("_hist")] + "_active"))
    return lay


def test_run_all(spark, layout):
    ctx = RunContext(fx.RUN_DATE, fx.CURRENT_DATE)
    run_all(spark, layout, ctx)
    usage = read_table(spark, layout.where("usge_dly_aggr"))
    assert usage.columns[-1] == "evnt_strt"
    got = sorted((r.subs_key, r.dwld_vlum_qty, r.upld_vlum_qty, r.actl_data_vlum_qty,
                  r.data_rnd_unit_qty, r.evnt_strt) for r in usage.collect())
    assert got == sorted(fx.EXPECTED_DAILY)
    enriched = read_table(spark, layout.where("subs_enriched")).withColumn(
        "run_date", F.col("run_date").cast("string"))
    assert fx.sorted_rows(enriched.select(*enriched.columns)) == fx.as_sorted(fx.EXPECTED_ENRICHED)
    prof = read_table(spark, layout.where("subs_profile"))
    assert fx.sorted_rows(prof, fx.PROFILE_CHECKED) == fx.as_sorted(fx.EXPECTED_AS_WRITTEN)


def test_rerun_next_day_keeps_old_partitions(spark, layout):
    ctx1 = RunContext(fx.RUN_DATE, fx.CURRENT_DATE)
    run_all(spark, layout, ctx1)
    ctx2 = RunContext(fx.RUN_DATE + dt.timedelta(days=1), fx.CURRENT_DATE)
    run_all(spark, layout, ctx2)
    prof = read_table(spark, layout.where("subs_profile"))
    dates = sorted({str(r.run_date) for r in prof.select("run_date").collect()})
    assert dates == ["2024-01-25", "2024-01-26"]
    # re-running the first date leaves exactly one copy of it
    run_all(spark, layout, ctx1)
    prof = read_table(spark, layout.where("subs_profile"))
    assert prof.where("run_date = '2024-01-25'").count() == len(fx.EXPECTED_AS_WRITTEN)


def test_active_route_when_run_date_is_today(spark, layout):
    from submart.plans.pipelines import enrichment_result, enrichment_specs
    sources, _ = enrichment_specs(layout)
    df = enrichment_result(spark, sources, RunContext(fx.RUN_DATE, fx.RUN_DATE))
    # the active tables hold every version: no as-of filter, no de-duplication
    assert df.count() == fx.subs_hist(spark).count() + 1  # status 11 has two rows


def test_usage_window_partition_pruning(spark):
    lay = Layout(root=shared_dir(spark, "pruned"))
    src = fx.usage(spark).withColumn("evnt_dt", F.to_date("evnt_strt_ts"))
    src.write.partitionBy("evnt_dt").parquet(lay.where("vw_usge"))
    run_usage_daily(spark, lay, RunContext(fx.RUN_DATE, fx.CURRENT_DATE),
                    partition_column="evnt_dt")
    got = sorted(tuple(r) for r in read_table(spark, lay.where("usge_dly_aggr")).collect())
    assert got == sorted(fx.EXPECTED_DAILY)


def test_parse_context(spark):
    ctx = parse_context(spark, "25/01/2024", "dd/MM/yyyy", current_date=fx.CURRENT_DATE)
    assert ctx.run_date == fx.RUN_DATE and not ctx.reads_active
    with pytest.raises(Exception):
        parse_context(spark, "2024-02-30", "yyyy-MM-dd")


def test_cli_runs_all_jobs(spark, layout):
    from submart.plans.cli import main
    assert main(["all", "25/01/2024", "dd/MM/yyyy", "error", "--root", layout.root,
                 "--current-date", "2024-03-01"]) == 0
    prof = read_table(spark, layout.where("subs_profile")).where("run_date = '2024-01-25'")
    assert fx.sorted_rows(prof, fx.PROFILE_CHECKED) == fx.as_sorted(fx.EXPECTED_AS_WRITTEN)


def test_profile_usage_bounds(spark, layout):
    from submart.plans.pipelines import profile_result, profile_specs
    ctx = RunContext(fx.RUN_DATE, fx.CURRENT_DATE)
    run_all(spark, layout, ctx)
    sources, _ = profile_specs(layout)
    df = profile_result(spark, sources, ctx, "per_subscriber", usage_to=fx.RUN_DATE)
    row = df.where("subs_key = 1").first()
    assert row.dwld_vlum_qty == 300  # the 26th is left out


def test_monthly_grain_job(spark):
    lay = Layout(root=shared_dir(spark, "monthly"))
    fx.usage(spark).write.parquet(lay.where("vw_usge"))
    run_usage_daily(spark, lay, RunContext(fx.RUN_DATE, fx.CURRENT_DATE), grain="MONTHLY")
    got = sorted(tuple(r) for r in read_table(spark, lay.where("usge_dly_aggr"))
                 .withColumn("evnt_strt", F.col("evnt_strt").cast("string")).collect())
    assert got == sorted(fx.EXPECTED_MONTHLY_ALIGNED)


def test_until_run_date_window(spark):
    lay = Layout(root=shared_dir(spark, "until"))
    fx.usage(spark).write.parquet(lay.where("vw_usge"))
    run_usage_daily(spark, lay, RunContext(fx.RUN_DATE, fx.CURRENT_DATE), until_run_date=True)
    days = {r.evnt_strt for r in read_table(spark, lay.where("usge_dly_aggr")).collect()}
    assert max(days) == fx.RUN_DATE


def test_source_registered_as_view(spark, layout):
    from submart.sources import read_source
    from submart.specs import SourceSpec
    spec = SourceSpec(name="vw_subs", kind="DELTA_SCD4", active=layout.where("vw_subs_active"),
                      hist=layout.where("vw_subs_hist"), keys="subs_key", ts_column="ecf_nsrt_ts",
                      view_name="vw_subs")
    read_source(spark, spec, RunContext(fx.RUN_DATE, fx.CURRENT_DATE))
    assert spark.sql("select count(*) from vw_subs").first()[0] == 4


def test_null_subscriber_keys_in_stored_history(spark):
    lay = Layout(root=shared_dir(spark, "nullkeys"))
    extra = spark.createDataFrame(
        [(None, "N1", 10, 100, None, None, None, None, None, None, 1000, None, None, 5000,
          fx.ts("2024-01-02 00:00:00"))], fx.SUBS_SCHEMA)
    tables = dict(SOURCES, vw_subs_hist=lambda s: fx.subs_hist(s).unionByName(extra))
    for name, make in tables.items():
        make(spark).write.parquet(lay.where(name))
        if name.endswith("_hist"):
            make(spark).write.parquet(lay.where(name[:-len("_hist")] + "_active"))
    run_all(spark, lay, RunContext(fx.RUN_DATE, fx.CURRENT_DATE))
    prof = read_table(spark, lay.where("subs_profile"))
    got = fx.sorted_rows(prof, fx.PROFILE_CHECKED)
    # the job's rows for subscribers 1-5, plus the NULL-key subscriber with
    # its account and customer but no enrichment and no usage
    assert got == fx.as_sorted(fx.EXPECTED_AS_WRITTEN + [
        (None, None, None, "A1000", "C5000", None, None, None, None)])


def test_usage_dedup_flag(spark):
    lay = Layout(root=shared_dir(spark, "dedup"))
    usage = fx.usage(spark)
    usage.unionByName(usage).write.parquet(lay.where("vw_usge"))  # every row twice
    run_usage_daily(spark, lay, RunContext(fx.RUN_DATE, fx.CURRENT_DATE), drop_duplicates=True)
    got = sorted(tuple(r) for r in read_table(spark, lay.where("usge_dly_aggr")).collect())
    assert got == sorted(fx.EXPECTED_DAILY)
