"""Subscriber enrichment with status and customer-type lookups (P2's query)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import UNKNOWN, unknown_default
from .joins import fits_broadcast, hot_keys, lookup_join

#: The enrichment's output, in order
ENRICHED_COLUMNS = ("subs_key", "subs_stts_key", "subs_stts_ds", "cust_type_key",
                    "cust_type_ds", "run_date")


def enrich_subscribers(subs: DataFrame, stts: DataFrame, cust_type: DataFrame,
                       run_date: dt.date, unknown: str = UNKNOWN,
                       stts_probe: DataFrame | None = None,
                       cust_type_probe: DataFrame | None = None,
                       stts_small: bool | None = None,
                       cust_type_small: bool | None = None,
                       hot_key_rows: int | None = None,
                       buckets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``subs`` left-joined to both lookups; a missing or NULL description is
    ``unknown``; the run date is stamped as ISO text in ``run_date``.

    Tied lookup versions each produce a row, as the as-of read keeps ties.
    ``buckets`` (``hot_buckets`` of the stored subscribers, by key column) says
    where hot keys are without reading ``subs`` for it.
    """
    a = subs.select("subs_key", "subs_stts_key", "cust_type_key")
    b = stts.select(F.col("subs_stts_key").alias("__b_key"),
                    F.col("subs_stts_ds").alias("__b_ds"))
    c = cust_type.select(F.col("cust_type_key").alias("__c_key"),
                         F.col("cust_type_ds").alias("__c_ds"))
    if stts_small is None:
        stts_small = fits_broadcast(b if stts_probe is None else stts_probe)
    if cust_type_small is None:
        cust_type_small = fits_broadcast(c if cust_type_probe is None else cust_type_probe)
    salted = [k for k, small in (("subs_stts_key", stts_small), ("cust_type_key", cust_type_small))
              if not small]
    buckets = buckets or {}
    counted = [k for k in salted if k not in buckets]
    hot = hot_keys(a, counted, hot_key_rows) if counted else {}
    j = lookup_join(a, b, "subs_stts_key", "__b_key", small=stts_small, salt_by=["subs_key"],
                    hot=hot.get("subs_stts_key"), buckets=buckets.get("subs_stts_key"))
    j = lookup_join(j, c, "cust_type_key", "__c_key", small=cust_type_small,
                    salt_by=["subs_key"], hot=hot.get("cust_type_key"),
                    buckets=buckets.get("cust_type_key"))
    return j.select(
        "subs_key", "subs_stts_key",
        unknown_default("__b_ds", unknown).alias("subs_stts_ds"),
        "cust_type_key",
        unknown_default("__c_ds", unknown).alias("cust_type_ds"),
        F.lit(run_date.isoformat()).alias("run_date"))
