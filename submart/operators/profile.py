"""The dated subscriber profile (P3's query): four left joins and usage sums.

``mode="as_written"`` reproduces the job exactly: its GROUP BY lists the very
usage measures it sums, so a subscriber gets one row per distinct daily usage
tuple, each summed over the days having it (times any tie fan-out).
``mode="per_subscriber"`` gives the evident intent, usage summed per
subscriber; it is an option of ours.  Its grain is one row per distinct
combination of a subscriber's version, enrichment, account and customer: one
row per subscriber unless versions are tied and differ.

Plan (both modes): copies are collapsed before the joins.  Tied versions that
are equal in all columns used become one row with their number, on each side,
so T copies on both sides of a join meet as one row and not as T x T; the
sums are multiplied by the numbers.  Usage is reduced per subscriber *before* the join, so the
wide subscriber rows meet one row per distinct tuple (as written) or one row
(per subscriber) instead of one row per day.  In ``as_written`` the lookups
on account and customer keys come first and the two ``subs_key`` joins last;
the final GROUP BY includes ``subs_key``, so it runs on the partitioning the
last join left behind, without another shuffle.  Sums are linear, so summing
the per-tuple sums again gives exactly the job's totals, tie fan-out
included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import key_cast, sum_result_type
from .joins import fits_broadcast, hot_keys, lookup_join
from .usage import OUTPUT_MEASURES

#: Subscriber columns the profile reads
SUBS_COLUMNS = ("subs_key", "subs_id", "subs_stts_key", "prim_rsrc_valu_txt", "serv_tech_nm",
                "prod_nm", "orig_actv_ts", "subs_stts_ts", "imei_id", "prim_acct_key",
                "cust_type_key", "prod_type_key", "main_bill_offr_key", "cust_key")
ACCT_COLUMNS = ("acct_key", "acct_id", "acct_stts_key", "xtrn_id")
CUST_COLUMNS = ("cust_key", "cust_id", "cust_stat_key")
ENRICHED_USED = ("subs_stts_ds", "subs_stts_key", "cust_type_ds")

#: The profile's output, in order, as (output name, source)
PROFILE_OUTPUT = (
    ("subs_key", "a_subs_key"),
    ("subs_id", "a_subs_id"),
    ("subs_stts_ds", "b_subs_stts_ds"),
    ("subs_stts_key", "a_subs_stts_key"),
    ("cust_type_ds", "b_cust_type_ds"),
    ("subs_prim_rsrc_valu", "a_prim_rsrc_valu_txt"),
    ("serv_tech_nm", "a_serv_tech_nm"),
    ("prod_nm", "a_prod_nm"),
    ("subs_orig_actv_ts", "a_orig_actv_ts"),
    ("subs_stts_efft_ts", "a_subs_stts_ts"),
    ("sold_imei_id", "a_imei_id"),
    ("subs_prim_acct_key", "a_prim_acct_key"),
    ("cust_type_key", "a_cust_type_key"),
    ("prod_type_key", "a_prod_type_key"),
    ("subs_main_offr_key", "a_main_bill_offr_key"),
    ("prim_acct_key", "a_prim_acct_key"),
    ("subs_stts_rsn_key", "a_subs_stts_key"),
    ("acct_key", "e_acct_key"),
    ("acct_id", "e_acct_id"),
    ("acct_stts_key", "e_acct_stts_key"),
    ("xtrn_id", "e_xtrn_id"),
    ("cust_key", "f_cust_key"),
    ("cust_id", "f_cust_id"),
    ("cust_stat_key", "f_cust_stat_key"),
)
PROFILE_COLUMNS = tuple(n for n, _ in PROFILE_OUTPUT) + OUTPUT_MEASURES + ("run_date",)

#: the job's GROUP BY, beyond the measures: every subscriber column it
#: selects, the three enrichment columns, the account and customer columns
_GROUP_A = tuple(c for c in SUBS_COLUMNS if c != "cust_key")
MODES = ("as_written", "per_subscriber")


def _prefixed(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def _collapsed(df: DataFrame, number: str) -> DataFrame:
    """Distinct rows with how often each occurs (combined map-side)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(number))


def _keyed_enrichment(enriched: DataFrame, subs_key: T.DataType, key_cast_type: str) -> DataFrame:
    """The enrichment's used columns with its key as ``b_key``, cast to ``key_cast_type``.

    A stored key of the subscribers' own integral type is compared as it is,
    less the keys that the cast would lose: the same matches, and a table
    bucketed by the key is still known to be.
    """
    used = [F.col(c).alias(f"b_{c}") for c in ENRICHED_USED]
    stored, cast = enriched.schema["subs_key"].dataType, key_cast("subs_key", key_cast_type)
    if stored == subs_key and isinstance(stored, T.IntegralType) and isinstance(T.DataType.fromDDL(key_cast_type), T.IntegralType):
        return enriched.where(cast.isNotNull()).select(F.col("subs_key").alias("b_key"), *used)
    return enriched.select(cast.alias("b_key"), *used)


def build_profile(subs: DataFrame, enriched: DataFrame, acct: DataFrame, cust: DataFrame,
                  usage: DataFrame, run_date: dt.date, mode: str = "as_written",
                  key_cast_type: str = "int",
                  acct_probe: DataFrame | None = None, cust_probe: DataFrame | None = None,
                  acct_small: bool | None = None, cust_small: bool | None = None,
                  hot_key_rows: int | None = None, null_keys: bool | None = None,
                  buckets: dict[str, DataFrame] | None = None, one_row_per_key: bool = False) -> DataFrame:
    """Join the as-of subscribers to enrichment, account, customer and usage.

    ``enriched.subs_key`` is cast to ``key_cast_type`` for the join; bad text
    gives NULL (no match) rather than failing the job.  ``null_keys`` says
    whether ``subs`` may hold NULL subscriber keys; ``None`` checks ``subs``
    (a job that stops at the first such row, but over a skew-safe as-of read
    it runs that read: callers with the stored table should ask it instead,
    as the profile job does), ``False`` skips the NULL-key branch and
    ``True`` always plans it.  ``buckets`` (``hot_buckets`` of the stored
    subscribers, by their key column) says where hot lookup keys are without
    reading ``subs`` for it.  ``one_row_per_key`` says that ``subs`` is an
    active table: as written, its rows are not collapsed first, which would
    shuffle them on all their columns; copies are still summed rightly.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    a = _prefixed(subs, "a_", SUBS_COLUMNS)
    a = a.withColumn("n_a", F.lit(1).cast("bigint")) if one_row_per_key and mode == "as_written" else _collapsed(a, "n_a")
    b = _collapsed(_keyed_enrichment(enriched, subs.schema["subs_key"].dataType, key_cast_type), "n_b")
    e = _collapsed(_prefixed(acct, "e_", ACCT_COLUMNS), "n_e")
    f = _collapsed(_prefixed(cust, "f_", CUST_COLUMNS), "n_f")
    measures = [f"g_{m}" for m in OUTPUT_MEASURES]
    run = F.lit(run_date.isoformat()).alias("run_date")

    if acct_small is None:
        acct_small = fits_broadcast(_prefixed(acct, "e_", ACCT_COLUMNS) if acct_probe is None else acct_probe)
    if cust_small is None:
        cust_small = fits_broadcast(_prefixed(cust, "f_", CUST_COLUMNS) if cust_probe is None else cust_probe)
    # hot keys of both lookups in one pass over the subscribers alone
    salted = [k for k, small in (("a_prim_acct_key", acct_small), ("a_cust_key", cust_small))
              if not small]
    found = {f"a_{k}": b for k, b in (buckets or {}).items()}
    counted = [k for k in salted if k not in found]
    hot = hot_keys(_prefixed(subs, "a_", SUBS_COLUMNS), counted, hot_key_rows) if counted else {}

    def lookups(x: DataFrame) -> DataFrame:
        x = lookup_join(x, e, "a_prim_acct_key", "e_acct_key", small=acct_small,
                        salt_by=["a_subs_key"], hot=hot.get("a_prim_acct_key"), buckets=found.get("a_prim_acct_key"))
        return lookup_join(x, f, "a_cust_key", "f_cust_key", small=cust_small,
                           salt_by=["a_subs_key"], hot=hot.get("a_cust_key"), buckets=found.get("a_cust_key"))

    # A NULL subscriber key matches nothing in the subs_key joins, so those
    # rows skip them (their enrichment and usage columns are NULL) rather
    # than all hashing into one task; NULL keys on the right are dropped for
    # the same reason.  The split is made on the subscribers themselves: the
    # filter reaches the scan (Parquet null counts skip row groups), so the
    # NULL-key branch reads next to nothing and replays no join.
    keyed_a = a.where(F.col("a_subs_key").isNotNull())
    null_a = a.where(F.col("a_subs_key").isNull())
    # usually there are none: then the branch is not planned at all (the
    # check stops at the first such row; row-group statistics skip the rest)
    has_null_keys = (not null_a.isEmpty()) if null_keys is None else null_keys
    rb = b.where(F.col("b_key").isNotNull())

    def by_subscriber(x: DataFrame, g: DataFrame) -> DataFrame:
        rg = g.where(F.col("g_subs_key").isNotNull())
        return (x.join(rb, F.col("a_subs_key") == F.col("b_key"), "left")
                 .join(rg, F.col("a_subs_key") == F.col("g_subs_key"), "left"))

    def without_match(x: DataFrame, g: DataFrame) -> DataFrame:
        return x.select(*x.columns, *[F.lit(None).cast(fld.dataType).alias(fld.name)
                                      for fld in (*rb.schema.fields, *g.schema.fields)])

    if mode == "per_subscriber":
        g = (usage.groupBy(F.col("subs_key").alias("g_subs_key"))
                  .agg(*[F.sum(m).alias(f"g_{m}") for m in OUTPUT_MEASURES]))
        # the subs_key joins reuse the as-of read's partitioning; then lookups
        x = by_subscriber(keyed_a, g)
        if has_null_keys:
            x = x.unionByName(without_match(null_a, g))
        x = lookups(x)
        return x.select(*[F.col(src).alias(out) for out, src in PROFILE_OUTPUT],
                        *[F.col(f"g_{m}").alias(m) for m in OUTPUT_MEASURES], run)

    # as written: one row per (subscriber, distinct usage tuple); the per-tuple
    # sums are summed again after the joins, times the copies of each side
    g = (usage.groupBy(F.col("subs_key").alias("g_subs_key"),
                       *[F.col(m).alias(f"g_{m}") for m in OUTPUT_MEASURES])
              .agg(*[F.sum(m).alias(f"s_{m}") for m in OUTPUT_MEASURES]))
    group = ([f"a_{c}" for c in _GROUP_A] + [f"b_{c}" for c in ENRICHED_USED]
             + [f"e_{c}" for c in ACCT_COLUMNS] + [f"f_{c}" for c in CUST_COLUMNS]
             + measures + ["g_subs_key"])
    types = {fld.name: fld.dataType for fld in usage.schema.fields}
    copies = F.coalesce(F.col("n_a"), F.lit(1))
    for n in ("n_b", "n_e", "n_f"):
        copies = copies * F.coalesce(F.col(n), F.lit(1))
    sums = [F.sum(F.col(f"s_{m}") * copies).cast(sum_result_type(types[m])).alias(m) for m in OUTPUT_MEASURES]
    # keyed rows: the GROUP BY holds a_subs_key, so it runs on the last
    # join's partitioning; NULL-key rows: their own (map-side combined) one
    out = by_subscriber(lookups(keyed_a), g).groupBy(*group).agg(*sums)
    if has_null_keys:
        out = out.unionByName(without_match(lookups(null_a), g).groupBy(*group).agg(*sums))
    return out.select(*[F.col(src).alias(out_name) for out_name, src in PROFILE_OUTPUT],
                      *OUTPUT_MEASURES, run)
