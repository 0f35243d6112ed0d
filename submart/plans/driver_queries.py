"""One query per operator, over the driver's tables (see ``driver_tables``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables.  The sink queries write to a fresh folder under the shared
checkpoint folder and return a lazy read of what they wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import window_start
from ..functions.exprs import key_cast
from ..operators.enrich import enrich_subscribers
from ..operators.joins import fits_broadcast_many, salted_left_join
from ..operators.profile import build_profile
from ..operators.usage import OUTPUT_MEASURES, aggregate_usage
from ..session import shared_dir
from ..sources.readers import (read_source, scd1_window, scd4_active, scd4_asof,
                               snapshot)
from ..sources.sinks import MODE_CONF, overwrite_partitions, read_table, write_table
from ..specs import RunContext, ScdKind, SourceSpec, TargetSpec
from . import driver_tables as dt_
from .driver_tables import (ASOF_DATE, RUN_DATE, SNAPSHOT_DATE, WINDOW_DAYS, table)
from .pipelines import VERSION_TS, Layout, parse_context, run_all

SKEW_SAFE_HOT_KEY_ROWS = 50
USAGE_TARGET_COLUMNS = ("subs_key",) + OUTPUT_MEASURES + ("evnt_strt",)


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _history(ctx_date: dt.date) -> RunContext:
    # a run date other than today: DELTA_SCD4 sources are read from history
    return RunContext(run_date=ctx_date, current_date=ctx_date + dt.timedelta(days=1))


# ------------------------------------------------------------------ readers

def scd1_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(name="events", kind=ScdKind.CURRENT_SCD1, location=_path(sf_dir, "events"),
                      ts_column="ts", window_days=WINDOW_DAYS,
                      columns=("event_id", "user_id", "event_type"))
    return read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))


def scd1_full_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(name="events", kind=ScdKind.CURRENT_SCD1, location=_path(sf_dir, "events"),
                      columns=("event_id", "user_id", "event_type"))
    return read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))


def _orders_spec(sf_dir: str, **kw) -> SourceSpec:
    return SourceSpec(name="orders", kind=ScdKind.DELTA_SCD4, active=_path(sf_dir, "orders"),
                      hist=_path(sf_dir, "orders"), keys="o_custkey", ts_column="o_orderdate", **kw)


def scd4_asof_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _orders_spec(sf_dir)
    df = read_source(spark, spec, _history(ASOF_DATE))
    return df.select("o_custkey", "o_orderkey", "o_orderstatus", "rnk")


def scd4_asof_tie_break_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 with the tie-break option: one version per key even when tied."""
    spec = _orders_spec(sf_dir, tie_break=("o_orderkey",))
    df = read_source(spark, spec, _history(ASOF_DATE))
    return df.select("o_custkey", "o_orderkey", "o_orderstatus", "rnk")


def scd1_window_until_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 with the optional upper bound: nothing after the run date."""
    spec = SourceSpec(name="events", kind=ScdKind.CURRENT_SCD1, location=_path(sf_dir, "events"),
                      ts_column="ts", window_days=WINDOW_DAYS, window_until_run_date=True,
                      columns=("event_id", "user_id", "event_type"))
    return read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))


def scd4_active_route_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(name="customer", kind=ScdKind.DELTA_SCD4, active=_path(sf_dir, "customer"),
                      hist=_path(sf_dir, "orders"), keys="c_custkey", ts_column="o_orderdate",
                      columns=("c_custkey", "c_name", "c_nationkey"))
    # run date == current date: the active table, whole
    return read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))


def snapshot_read_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(name="orders", kind=ScdKind.SNAPSHOT, location=_path(sf_dir, "orders"),
                      snapshot_column="o_orderdate", columns=("o_orderkey", "o_custkey"))
    return read_source(spark, spec, RunContext(SNAPSHOT_DATE, RUN_DATE))


def source_dedup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(name="events", kind=ScdKind.CURRENT_SCD1, location=_path(sf_dir, "events"),
                      drop_duplicates=True)
    return (read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))
            .select("event_id", "user_id", "event_type"))


# --------------------------------------------------------------- transforms

def _usage_daily(spark: SparkSession, sf_dir: str, run_date: dt.date = RUN_DATE,
                 events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    windowed = scd1_window(dt_.usage(events), "evnt_strt_ts", run_date, WINDOW_DAYS)
    return aggregate_usage(windowed, "DAILY").toDF(*USAGE_TARGET_COLUMNS)


def usage_daily_aggr_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage_daily(spark, sf_dir)


def usage_monthly_aggr_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_usage(dt_.usage(table(spark, sf_dir, "events")), "MONTHLY")


def _small(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, bool]:
    """Which lookup tables are proven small enough to broadcast (one job)."""
    return fits_broadcast_many({n: table(spark, sf_dir, n) for n in names})


def usage_monthly_aligned_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 over a window aligned to the first of its month (Q8)."""
    days = (RUN_DATE - window_start(RUN_DATE, WINDOW_DAYS, align_month=True)).days
    windowed = scd1_window(dt_.usage(table(spark, sf_dir, "events")), "evnt_strt_ts",
                           RUN_DATE, days)
    return aggregate_usage(windowed, "MONTHLY")


def _enrichment(spark: SparkSession, sf_dir: str, run_date: dt.date = RUN_DATE,
                small: dict[str, bool] | None = None,
                hot_key_rows: int | None = None) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    small = small or _small(spark, sf_dir, "nation", "region")
    return enrich_subscribers(scd4_active(dt_.subscribers(customer)), dt_.status_lookup(nation),
                              dt_.cust_type_lookup(region), run_date,
                              stts_small=small["nation"], cust_type_small=small["region"],
                              hot_key_rows=hot_key_rows)


def enrich_status_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enrichment(spark, sf_dir)


def cast_key_left_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    a = customer.select(F.col("c_custkey").alias("a_key"))
    # the stored key is text, some of it bad: bad text must not match or fail
    b = customer.select(
        F.when(F.col("c_custkey") % 50 == 0, F.lit("bad"))
         .otherwise(F.col("c_custkey").cast("string")).alias("b_sk"),
        F.col("c_name").alias("b_name"))
    # text that does not cast gives a NULL key: it can match nothing, so it
    # is dropped before the shuffle instead of piling into one task
    b = b.withColumn("b_key", key_cast("b_sk", "bigint")).where(F.col("b_key").isNotNull())
    j = a.join(b, F.col("a_key") == F.col("b_key"), "left")
    return j.select(F.col("a_key").alias("subs_key"), F.col("b_name").alias("subs_id"))


def _profile(spark: SparkSession, sf_dir: str, mode: str, skew_safe: bool = False) -> DataFrame:
    customer, nation, orders = (table(spark, sf_dir, t) for t in ("customer", "nation", "orders"))
    hot_key_rows = None
    if skew_safe:
        # every lookup shuffled and salted; each nation key (shared by
        # thousands of customers at scale) counts as hot from 50 rows on
        small = {"nation": False, "region": False, "orders": False}
        hot_key_rows = SKEW_SAFE_HOT_KEY_ROWS
    else:
        small = _small(spark, sf_dir, "nation", "region", "orders")
    enriched = dt_.as_stored_enrichment(_enrichment(spark, sf_dir, small=small,
                                                    hot_key_rows=hot_key_rows))
    acct = dt_.accounts(scd4_asof(orders, ["o_custkey"], "o_orderdate", RUN_DATE,
                                  skew_safe=True if skew_safe else None,
                                  hot_key_rows=hot_key_rows))
    return build_profile(
        subs=scd4_active(dt_.subscribers(customer)),
        enriched=snapshot(enriched, "run_date", RUN_DATE),
        acct=acct, cust=dt_.customers(nation),
        # every day of usage, as the job sums its whole usage table
        usage=aggregate_usage(dt_.usage(table(spark, sf_dir, "events")), "DAILY").toDF(*USAGE_TARGET_COLUMNS),
        run_date=RUN_DATE, mode=mode, key_cast_type="bigint",
        acct_small=small["orders"], cust_small=small["nation"], hot_key_rows=hot_key_rows, one_row_per_key=True)


def profile_as_written_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "as_written")


def profile_per_subscriber_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "per_subscriber")


def profile_as_written_skewsafe_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile with no lookup broadcast: salted joins, hot keys split."""
    return _profile(spark, sf_dir, "as_written", skew_safe=True)


# -------------------------------------------------------------------- sinks

def restate_usage_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs into one table; the second restates its window.

    Run 1 (2024-01-20) happens at noon of its run date, so it sees only the
    events up to then and writes that day in part.  Run 2 (2024-01-25) sees
    everything and overwrites its 10-day window.  Days before run 2's window
    must survive from run 1, and the part-day must be restated.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    target = TargetSpec(name="usge_dly_aggr", location=shared_dir(spark, "restate"),
                        partition_columns=("evnt_strt",), columns=USAGE_TARGET_COLUMNS,
                        keys=("subs_key",), rebalance=True,
                        files_per_partition=max(1, parts // (WINDOW_DAYS + 1)))
    events = table(spark, sf_dir, "events")
    # a zone-free literal, like the column: no session or process zone involved
    noon = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    seen_at_noon = events.where(F.col("ts") < noon)
    overwrite_partitions(_usage_daily(spark, sf_dir, dt.date(2024, 1, 20), seen_at_noon), target)
    overwrite_partitions(_usage_daily(spark, sf_dir, RUN_DATE, events), target)
    return read_table(spark, target.location)


def full_table_overwrite_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = shared_dir(spark, "full-table")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    write_table(nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")),
                location, "overwrite")
    write_table(region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")),
                location, "overwrite")
    return read_table(spark, location)


def snapshot_write_read_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates into one table, the second twice: the first must survive."""
    target = TargetSpec(name="subs_enriched", location=shared_dir(spark, "snapshot"),
                        partition_columns=("run_date",), keys=("subs_key",))
    small = _small(spark, sf_dir, "nation", "region")
    overwrite_partitions(_enrichment(spark, sf_dir, dt_.PREVIOUS_RUN_DATE, small), target)
    overwrite_partitions(_enrichment(spark, sf_dir, RUN_DATE, small), target)
    overwrite_partitions(_enrichment(spark, sf_dir, RUN_DATE, small), target)  # a re-run
    # path discovery types the partition as DATE; the job stored ISO text
    return read_table(spark, target.location).withColumn("run_date", F.col("run_date").cast("string"))


def source_dedup_full_row_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 on a stored table with equal rows: they go before the projection."""
    location = shared_dir(spark, "visits")
    write_table(table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day")), location)
    spec = SourceSpec(name="visits", kind=ScdKind.CURRENT_SCD1, location=location,
                      columns=("user_id", "event_type"), drop_duplicates=True)
    return read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))


def scd4_asof_latest_large_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 as a history with hot keys is read: the same rows."""
    spec = _orders_spec(sf_dir, skew_safe=True)
    return read_source(spark, spec, _history(ASOF_DATE)).select("o_custkey", "o_orderkey", "o_orderstatus", "rnk")


def enrich_salted_text_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 salted, with text keys on one side: ``'7'`` and ``'07'`` are one key."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    subs = customer.select(F.col("c_custkey").alias("subs_key"),
                           F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string"))
                            .otherwise(F.concat(F.lit("0"), F.col("c_nationkey").cast("string"))).alias("key"))
    lookup = nation.select(F.col("n_nationkey").alias("n_key"), F.col("n_name").alias("subs_stts_ds"))
    joined = salted_left_join(subs, lookup, "key", "n_key", salt_by=["subs_key"], hot_key_rows=2)
    return joined.select("subs_key", "subs_stts_ds")


# ------------------------------------------------------- the jobs end to end

def _mart_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The jobs' source tables, whole: a history row per driver row, and for
    each tenth subscriber a version after the run date, which must not count."""
    customer, nation, region, orders, events = (
        table(spark, sf_dir, t) for t in ("customer", "nation", "region", "orders", "events"))
    subs = dt_.subscribers(customer)
    day = F.lit("2024-01-01").cast("timestamp")
    versions = subs.withColumn(VERSION_TS, day).unionByName(
        subs.where(F.col("subs_key") % 10 == 0).withColumn("subs_id", F.lit("later"))
            .withColumn(VERSION_TS, F.lit("2024-03-01").cast("timestamp")))
    accounts = dt_.accounts(orders, F.col("o_orderdate").cast("timestamp").alias(VERSION_TS))
    named = {"vw_subs": versions,
             "vw_subs_stts": dt_.status_lookup(nation).withColumn(VERSION_TS, day),
             "vw_cust_type": dt_.cust_type_lookup(region).withColumn(VERSION_TS, day),
             "vw_acct": accounts,
             "vw_cust": dt_.customers(nation).withColumn(VERSION_TS, day)}
    out = {"vw_usge": dt_.usage(events)}
    for name, df in named.items():
        out[f"{name}_hist"] = df
        out[f"{name}_active"] = df.limit(0)      # a past run date reads no active table
    return out


def _run_jobs(spark: SparkSession, layout: Layout, **kw) -> None:
    later = RUN_DATE + dt.timedelta(days=30)
    for date in (dt_.PREVIOUS_RUN_DATE, RUN_DATE, RUN_DATE):
        run_all(spark, layout, parse_context(spark, date.strftime("%d/%m/%Y"), "dd/MM/yyyy", later), **kw)


USAGE_DAY = "evnt_day"


def pipeline_profile_path_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1, P2 and P3 over stored tables for two run dates and a re-run; usage is
    stored by day, so the usage job lists only its window's folders."""
    layout = Layout(root=shared_dir(spark, "mart"))
    for name, df in _mart_sources(spark, sf_dir).items():
        if name == "vw_usge":
            by_day = df.withColumn(USAGE_DAY, F.to_date("evnt_strt_ts"))
            by_day.repartition(USAGE_DAY).write.partitionBy(USAGE_DAY).parquet(layout.where(name))
        else:
            write_table(df, layout.where(name))
    _run_jobs(spark, layout, usage={"partition_column": USAGE_DAY})
    spec = SourceSpec(name="subs_profile", kind=ScdKind.CURRENT_SCD1, location=layout.where("subs_profile"),
                      view_name="subs_profile")
    read_source(spark, spec, RunContext(RUN_DATE, RUN_DATE))
    return spark.table("subs_profile").withColumn("run_date", F.col("run_date").cast("string"))


def _in_database(spark: SparkSession, name: str, work: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The rows that ``work`` finds in a database of its own, which is dropped afterwards.

    It runs in a session of its own, as the overwrite mode is the session's.
    """
    location = shared_dir(spark, name)
    database = f"mart_{location[-12:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    session = spark.newSession()
    session.conf.set(MODE_CONF, "dynamic")
    kept = shared_dir(spark, f"{name}-rows")
    try:
        write_table(work(session, database), kept)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return read_table(spark, kept)


def pipeline_profile_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over catalog tables, written by ``insertInto``."""
    def work(session: SparkSession, database: str) -> DataFrame:
        layout = Layout(database=database)
        for name, df in _mart_sources(session, sf_dir).items():
            write_table(df, layout.where(name))
        _run_jobs(session, layout)
        return session.table(layout.where("subs_profile"))

    return _in_database(spark, "mart-db", work)


#: buckets of the subscriber key in the bucketed mart
BUCKETS = 8


def bucketed_mart(spark: SparkSession, sf_dir: str, database: str) -> Layout:
    """Sources in a database, the subscriber history in buckets of its key, and a layout that buckets the targets."""
    layout = Layout(database=database, buckets=BUCKETS)
    for name, df in _mart_sources(spark, sf_dir).items():
        if name == "vw_subs_hist":
            df.repartition(BUCKETS, "subs_key").write.bucketBy(BUCKETS, "subs_key").saveAsTable(layout.where(name))
        else:
            write_table(df, layout.where(name))
    return layout


def pipeline_profile_bucketed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, A4, A5, P3 over tables stored in buckets of the subscriber key: the
    profile's joins by it, and its usage sums, read without a shuffle."""
    def work(session: SparkSession, database: str) -> DataFrame:
        layout = bucketed_mart(session, sf_dir, database)
        _run_jobs(session, layout)
        return session.table(layout.where("subs_profile"))

    return _in_database(spark, "mart-buckets", work)


def path_partitions_registered_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 into a path with a catalog table over it: each run date is in the table at once, without a repair."""
    def work(session: SparkSession, database: str) -> DataFrame:
        target = TargetSpec(name="subs_enriched", location=shared_dir(session, "registered"), partition_columns=("run_date",),
                            keys=("subs_key",), catalog_table=f"{database}.subs_enriched")
        for date in (dt_.PREVIOUS_RUN_DATE, RUN_DATE, RUN_DATE):
            overwrite_partitions(_enrichment(session, sf_dir, date), target)
        return session.table(target.catalog_table)

    return _in_database(spark, "registered-db", work)


def write_modes_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 with all four modes on catalog tables: regions first, then nations into the same table."""
    def work(session: SparkSession, database: str) -> DataFrame:
        regions = table(session, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("k"), F.col("r_name").alias("name"))
        nations = table(session, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name"))
        out = None
        for mode in ("append", "overwrite", "ignore", "error"):
            location, refused = f"{database}.t_{mode}", False
            write_table(regions, location, mode)
            try:
                write_table(nations, location, mode)
            except AnalysisException as e:
                if mode != "error" or "ALREADY_EXISTS" not in (e.getCondition() or ""):
                    raise
                refused = True
            rows = read_table(session, location).select(F.lit(mode).alias("mode"), F.lit(refused).alias("refused"), "k", "name")
            out = rows if out is None else out.unionByName(rows)
        return out

    return _in_database(spark, "modes-db", work)


QUERIES = {
    "scd1_window": scd1_window_q,
    "scd1_full": scd1_full_q,
    "scd4_asof_latest": scd4_asof_latest_q,
    "scd4_asof_tie_break": scd4_asof_tie_break_q,
    "scd1_window_until": scd1_window_until_q,
    "scd4_active_route": scd4_active_route_q,
    "snapshot_read": snapshot_read_q,
    "source_dedup": source_dedup_q,
    "usage_daily_aggr": usage_daily_aggr_q,
    "usage_monthly_aggr": usage_monthly_aggr_q,
    "usage_monthly_aligned": usage_monthly_aligned_q,
    "enrich_status_type": enrich_status_type_q,
    "cast_key_left_join": cast_key_left_join_q,
    "profile_as_written": profile_as_written_q,
    "profile_per_subscriber": profile_per_subscriber_q,
    "profile_as_written_skewsafe": profile_as_written_skewsafe_q,
    "restate_usage_window": restate_usage_window_q,
    "full_table_overwrite": full_table_overwrite_q,
    "snapshot_write_read": snapshot_write_read_q,
    "source_dedup_full_row": source_dedup_full_row_q,
    "scd4_asof_latest_large": scd4_asof_latest_large_q,
    "enrich_salted_text_key": enrich_salted_text_key_q,
    "pipeline_profile_path": pipeline_profile_path_q,
    "pipeline_profile_catalog": pipeline_profile_catalog_q,
    "pipeline_profile_bucketed": pipeline_profile_bucketed_q,
    "path_partitions_registered": path_partitions_registered_q,
    "write_modes_catalog": write_modes_catalog_q,
}
