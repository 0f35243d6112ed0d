"""The driver's TPC-H-like tables seen as the mart's sources.

=============  ===============  ==========================================
role           driver table     mapping
=============  ===============  ==========================================
usage          ``events``       ``subs_key`` = ``user_id``, ``evnt_strt_ts`` =
                                ``ts``; type ``'D'`` for purchases, else
                                ``'V'``; integer measures, some NULL
version hist   ``orders``       key ``o_custkey``, version time ``o_orderdate``
                                (real ties)
subscribers    ``customer``     ``subs_key`` = ``c_custkey``
status lookup  ``nation``       subscribers' keys are ``c_custkey % 30``: 25 to
                                29 are unknown
type lookup    ``region``       key ``c_nationkey % 7``: 5 and 6 are unknown
customers      ``nation``       ``cust_key`` = ``n_nationkey``
=============  ===============  ==========================================

Money becomes integer cents so sums compare exactly with other engines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The dates the driver queries run at
RUN_DATE = dt.date(2024, 1, 25)
WINDOW_DAYS = 10
ASOF_DATE = dt.date(1999, 6, 30)
SNAPSHOT_DATE = dt.date(1998, 10, 3)
PREVIOUS_RUN_DATE = dt.date(2024, 1, 24)
STATUS_MODULUS = 30
CUST_TYPE_MODULUS = 7


_LOADED: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, loaded once per session (the files are read-only).

    Loading lists the file and reads its footer in a small Spark job; the
    DataFrame handle is reused so a query touching a table three times pays
    that once.  No data is cached.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _LOADED.get(key)
    if df is None or df.sparkSession is not spark:
        df = _LOADED[key] = spark.read.parquet(path)
    return df


def usage(events: DataFrame) -> DataFrame:
    """``events`` as ``vw_usge``."""
    return events.select(
        F.col("user_id").alias("subs_key"),
        F.col("ts").alias("evnt_strt_ts"),
        F.when(F.col("event_type") == "purchase", F.lit("D")).otherwise(F.lit("V"))
         .alias("serv_type_cd"),
        F.round(F.col("value") * 100).cast("bigint").alias("dwld_vlum_qty"),
        F.when(F.col("event_type") == "view", F.lit(None))
         .otherwise(F.col("event_id") % 97).cast("bigint").alias("upld_vlum_qty"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None))
         .otherwise(F.col("event_id") % 13).cast("bigint").alias("actl_data_vlum_qty"),
        F.lit(1).cast("bigint").alias("rnd_unit_cnt"))


def subscribers(customer: DataFrame) -> DataFrame:
    """``customer`` as ``vw_subs`` (active); attributes it lacks are NULL."""
    return customer.select(
        F.col("c_custkey").alias("subs_key"),
        F.col("c_name").alias("subs_id"),
        (F.col("c_custkey") % STATUS_MODULUS).cast("int").alias("subs_stts_key"),
        F.lit(None).cast("string").alias("prim_rsrc_valu_txt"),
        F.lit(None).cast("string").alias("serv_tech_nm"),
        F.col("c_mktsegment").alias("prod_nm"),
        F.lit(None).cast("timestamp").alias("orig_actv_ts"),
        F.lit(None).cast("timestamp").alias("subs_stts_ts"),
        F.lit(None).cast("string").alias("imei_id"),
        F.col("c_custkey").alias("prim_acct_key"),
        (F.col("c_nationkey") % CUST_TYPE_MODULUS).alias("cust_type_key"),
        F.lit(None).cast("int").alias("prod_type_key"),
        F.lit(None).cast("int").alias("main_bill_offr_key"),
        F.col("c_nationkey").alias("cust_key"))


def status_lookup(nation: DataFrame) -> DataFrame:
    """``nation`` as ``vw_subs_stts``."""
    return nation.select(F.col("n_nationkey").alias("subs_stts_key"),
                         F.col("n_name").alias("subs_stts_ds"))


def cust_type_lookup(region: DataFrame) -> DataFrame:
    """``region`` as ``vw_cust_type``."""
    return region.select(F.col("r_regionkey").alias("cust_type_key"),
                         F.col("r_name").alias("cust_type_ds"))


def accounts(asof_orders: DataFrame, *more: Column) -> DataFrame:
    """As-of ``orders`` as ``vw_acct``: one account per customer, ties kept."""
    return asof_orders.select(
        F.col("o_custkey").alias("acct_key"),
        F.col("o_orderkey").alias("acct_id"),
        F.lit(None).cast("int").alias("acct_stts_key"),
        F.col("o_orderpriority").alias("xtrn_id"), *more)


def customers(nation: DataFrame) -> DataFrame:
    """``nation`` as ``vw_cust``."""
    return nation.select(F.col("n_nationkey").alias("cust_key"),
                         F.col("n_name").alias("cust_id"),
                         F.col("n_regionkey").alias("cust_stat_key"))


def as_stored_enrichment(enriched: DataFrame) -> DataFrame:
    """The enrichment as the snapshot table keeps it: ``subs_key`` as text."""
    return enriched.withColumn("subs_key", F.col("subs_key").cast("string"))
