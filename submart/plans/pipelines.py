"""The three jobs, run-date parameterised: usage, enrichment, profile.

Each job is ``read_source() x n -> transform -> overwrite_partitions()``.
Each source is loaded once.  The plans of the usage and enrichment jobs need
no job of their own; the profile counts its two lookups, which it broadcasts
on proof, and asks whether a subscriber key is NULL.  Run order for one run date is usage
and enrichment (either order), then profile, which reads what the first two
wrote, so its lineage starts at stored tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_run_date, session_today, window_start
from ..operators.enrich import ENRICHED_COLUMNS, enrich_subscribers
from ..operators.joins import MEASURED, common_key_type, fits_broadcast_many, hot_buckets, measured_broadcast
from ..operators.profile import PROFILE_COLUMNS, build_profile
from ..operators.usage import OUTPUT_MEASURES, aggregate_usage
from ..sources.readers import read_source, stored_rows
from ..sources.sinks import overwrite_partitions
from ..specs import RunContext, ScdKind, SourceSpec, TargetSpec

#: The jobs' settings
USAGE_WINDOW_DAYS = 40
VERSION_TS = "ecf_nsrt_ts"
USAGE_TS = "evnt_strt_ts"
USAGE_PARTITION = "evnt_strt"
SNAPSHOT_COLUMN = "run_date"


@dataclass(frozen=True)
class Layout:
    """Where the mart's tables live: under a path root or in a database.

    ``register_in`` names a database that gets a table over each target under
    a root, with its partitions.  ``buckets`` stores a database's usage and
    enrichment by subscriber key in as many buckets.
    """

    root: str | None = None
    database: str | None = None
    format: str = "parquet"
    register_in: str | None = None
    buckets: int | None = None

    def __post_init__(self):
        if bool(self.root) == bool(self.database):
            raise ValueError("give exactly one of root and database")
        if (self.register_in and not self.root) or (self.buckets and not self.database):
            raise ValueError("register_in is for tables under a root, buckets are for a database")

    def where(self, table: str) -> str:
        if self.root:
            return f"{self.root.rstrip('/')}/{table}"
        return f"{self.database}.{table}"

    def registered(self, table: str) -> str | None:
        return f"{self.register_in}.{table}" if self.register_in else None


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scd4(layout: Layout, name: str, keys: str, **kw) -> SourceSpec:
    return SourceSpec(name=name, kind=ScdKind.DELTA_SCD4, active=layout.where(f"{name}_active"),
                      hist=layout.where(f"{name}_hist"), keys=keys, ts_column=VERSION_TS,
                      format=layout.format, **kw)


# ---------------------------------------------------------------- P1 usage

def usage_specs(spark: SparkSession, layout: Layout, window_days: int = USAGE_WINDOW_DAYS,
                drop_duplicates: bool = False, partition_column: str | None = None,
                until_run_date: bool = False) -> tuple[SourceSpec, TargetSpec]:
    source = SourceSpec(name="vw_usge", kind=ScdKind.CURRENT_SCD1,
                        location=layout.where("vw_usge"), ts_column=USAGE_TS,
                        window_days=window_days, window_until_run_date=until_run_date,
                        drop_duplicates=drop_duplicates,
                        partition_column=partition_column, format=layout.format)
    target = TargetSpec(name="usge_dly_aggr", location=layout.where("usge_dly_aggr"),
                        partition_columns=(USAGE_PARTITION,),
                        columns=("subs_key",) + OUTPUT_MEASURES + (USAGE_PARTITION,),
                        keys=("subs_key",), format=layout.format, rebalance=True,
                        buckets=layout.buckets, catalog_table=layout.registered("usge_dly_aggr"),
                        # without AQE: a fixed number of files per day
                        files_per_partition=max(1, _shuffle_partitions(spark) // (window_days + 1)))
    return source, target


def usage_result(spark: SparkSession, source: SourceSpec, ctx: RunContext,
                 grain: str = "DAILY", align_month: bool = True) -> DataFrame:
    """P1's result: the trailing window rolled up by day (or month).

    A monthly roll-up moves the window start to the first of its month
    (unless ``align_month=False``), so no month is restated from part of it.
    """
    if grain.upper() == "MONTHLY" and align_month and source.window_days is not None:
        days = (ctx.run_date - window_start(ctx.run_date, source.window_days, True)).days
        source = SourceSpec(**{**source.__dict__, "window_days": days})
    return aggregate_usage(read_source(spark, source, ctx), grain=grain)


def run_usage_daily(spark: SparkSession, layout: Layout, ctx: RunContext,
                    grain: str = "DAILY", align_month: bool = True, **kw) -> TargetSpec:
    """P1.  ``grain="MONTHLY"`` writes ``'yyyy-MM-01'`` text into the same
    partition column (the job's other, unused, branch)."""
    source, target = usage_specs(spark, layout, **kw)
    overwrite_partitions(usage_result(spark, source, ctx, grain, align_month), target)
    return target


# ----------------------------------------------------------- P2 enrichment

def enrichment_specs(layout: Layout) -> tuple[dict[str, SourceSpec], TargetSpec]:
    sources = {
        "vw_subs": scd4(layout, "vw_subs", "subs_key"),
        "vw_subs_stts": scd4(layout, "vw_subs_stts", "subs_stts_key"),
        "vw_cust_type": scd4(layout, "vw_cust_type", "cust_type_key"),
    }
    target = TargetSpec(name="subs_enriched", location=layout.where("subs_enriched"),
                        partition_columns=(SNAPSHOT_COLUMN,), columns=ENRICHED_COLUMNS,
                        keys=("subs_key",), format=layout.format, buckets=layout.buckets,
                        catalog_table=layout.registered("subs_enriched"))
    return sources, target


def _load(spark: SparkSession, sources: dict[str, SourceSpec], ctx: RunContext
          ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Every source loaded once: the stored rows, and the sources as read."""
    stored = {name: stored_rows(spark, spec, ctx) for name, spec in sources.items()}
    return stored, {n: read_source(spark, s, ctx, stored[n]) for n, s in sources.items()}


def _sketches(stored: dict[str, DataFrame], lookups: dict[str, tuple[str, str]],
              small: dict[str, bool | str]) -> dict[str, DataFrame]:
    """Where the subscribers' keys of the large lookups are hot, from the stored key columns.

    ``lookups`` has for each lookup the subscribers' key and its own.
    """
    subs = stored["vw_subs"]
    keys = {mine: common_key_type(subs, stored[n], mine, theirs) for n, (mine, theirs) in lookups.items() if not small[n]}
    return hot_buckets(subs, keys) if keys else {}


ENRICHMENT_LOOKUPS = {"vw_subs_stts": ("subs_stts_key", "subs_stts_key"), "vw_cust_type": ("cust_type_key", "cust_type_key")}
PROFILE_LOOKUPS = {"vw_acct": ("prim_acct_key", "acct_key"), "vw_cust": ("cust_key", "cust_key")}


def enrichment_result(spark: SparkSession, sources: dict[str, SourceSpec],
                      ctx: RunContext) -> DataFrame:
    """P2's result.  No job runs before the write's own: a lookup of few stored
    bytes is left to AQE, which broadcasts it on the size it measures; without
    AQE it is counted; a larger one is joined with its hot keys spread."""
    stored, read = _load(spark, sources, ctx)
    small = {n: MEASURED if measured_broadcast(stored[n]) else False for n in ENRICHMENT_LOOKUPS}
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        small = fits_broadcast_many({n: stored[n] for n in ENRICHMENT_LOOKUPS})
    return enrich_subscribers(read["vw_subs"], read["vw_subs_stts"], read["vw_cust_type"],
                              ctx.run_date, stts_small=small["vw_subs_stts"],
                              cust_type_small=small["vw_cust_type"],
                              buckets=_sketches(stored, ENRICHMENT_LOOKUPS, small))


def run_subs_enriched(spark: SparkSession, layout: Layout, ctx: RunContext) -> TargetSpec:
    sources, target = enrichment_specs(layout)
    # one run_date per write: the result is already spread by subscriber,
    # so each task writes one file and no extra shuffle is needed
    overwrite_partitions(enrichment_result(spark, sources, ctx), target)
    return target


# --------------------------------------------------------------- P3 profile

def profile_specs(layout: Layout) -> tuple[dict[str, SourceSpec], TargetSpec]:
    sources = {
        "vw_subs": scd4(layout, "vw_subs", "subs_key"),
        "subs_enriched": SourceSpec(name="subs_enriched", kind=ScdKind.SNAPSHOT,
                                    location=layout.where("subs_enriched"),
                                    snapshot_column=SNAPSHOT_COLUMN, format=layout.format),
        "vw_cust": scd4(layout, "vw_cust", "cust_key"),
        "vw_acct": scd4(layout, "vw_acct", "acct_key"),
        # the job sets neither a window nor the de-duplication flag for this
        # source (it would fail on the missing settings); whole table, as is
        "usge_dly_aggr": SourceSpec(name="usge_dly_aggr", kind=ScdKind.CURRENT_SCD1,
                                    location=layout.where("usge_dly_aggr"),
                                    format=layout.format),
    }
    target = TargetSpec(name="subs_profile", location=layout.where("subs_profile"),
                        partition_columns=(SNAPSHOT_COLUMN,), columns=PROFILE_COLUMNS,
                        keys=("subs_key",), format=layout.format,
                        catalog_table=layout.registered("subs_profile"))
    return sources, target


def profile_result(spark: SparkSession, sources: dict[str, SourceSpec], ctx: RunContext,
                   mode: str = "as_written", usage_from: dt.date | None = None,
                   usage_to: dt.date | None = None) -> DataFrame:
    """P3's result.  The job sums every day in the usage table, after the run
    date too; ``usage_from`` / ``usage_to`` bound the days (partition pruned)."""
    stored, read = _load(spark, sources, ctx)
    small = fits_broadcast_many({n: stored[n] for n in PROFILE_LOOKUPS})
    if usage_from is not None:
        read["usge_dly_aggr"] = read["usge_dly_aggr"].where(F.col(USAGE_PARTITION) >= F.lit(usage_from))
    if usage_to is not None:
        read["usge_dly_aggr"] = read["usge_dly_aggr"].where(F.col(USAGE_PARTITION) <= F.lit(usage_to))
    # NULL subscriber keys, asked of the stored rows: IsNull reaches Parquet
    # and row-group null counts answer it without reading the data
    subs = sources["vw_subs"]
    null_keys = not stored["vw_subs"].where(F.col(subs.keys[0]).isNull()).isEmpty()
    return build_profile(read["vw_subs"], read["subs_enriched"], read["vw_acct"],
                         read["vw_cust"], read["usge_dly_aggr"], ctx.run_date, mode=mode,
                         acct_small=small["vw_acct"], cust_small=small["vw_cust"],
                         null_keys=null_keys, buckets=_sketches(stored, PROFILE_LOOKUPS, small),
                         one_row_per_key=ctx.reads_active)


def run_subs_profile(spark: SparkSession, layout: Layout, ctx: RunContext,
                     mode: str = "as_written", **kw) -> TargetSpec:
    sources, target = profile_specs(layout)
    overwrite_partitions(profile_result(spark, sources, ctx, mode, **kw), target)
    return target


def run_all(spark: SparkSession, layout: Layout, ctx: RunContext,
            mode: str = "as_written", usage: dict | None = None,
            profile: dict | None = None) -> None:
    """P1, P2, then P3 for one run date; ``usage`` and ``profile`` are further
    settings of ``run_usage_daily`` and ``run_subs_profile``."""
    run_usage_daily(spark, layout, ctx, **(usage or {}))
    run_subs_enriched(spark, layout, ctx)
    run_subs_profile(spark, layout, ctx, mode, **(profile or {}))


JOBS = {"usage": run_usage_daily, "enriched": run_subs_enriched, "profile": run_subs_profile,
        "all": run_all}


def parse_context(spark: SparkSession, run_date: str, fmt: str = "yyyy-MM-dd",
                  current_date: dt.date | None = None) -> RunContext:
    return RunContext(parse_run_date(spark, run_date, fmt),
                      current_date or session_today(spark))
