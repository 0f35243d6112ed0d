"""The hand-made fixture of FIXTURES.md §3 as DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = dt.date(2024, 1, 25)
CURRENT_DATE = dt.date(2024, 3, 1)  # differs from the run date: history is read
WINDOW_DAYS = 40


def ts(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


SUBS_SCHEMA = ("subs_key int, subs_id string, subs_stts_key int, cust_type_key int, "
               "prim_rsrc_valu_txt string, serv_tech_nm string, prod_nm string, "
               "orig_actv_ts timestamp, subs_stts_ts timestamp, imei_id string, "
               "prim_acct_key int, prod_type_key int, main_bill_offr_key int, cust_key int, "
               "ecf_nsrt_ts timestamp")

_SUBS = [
    # subs_key, subs_id, stts, type, acct, cust, version time
    (1, "S1", 10, 100, 1000, 5000, "2024-01-10 08:00:00"),
    (1, "S1", 11, 100, 1000, 5000, "2024-01-20 08:00:00"),
    (1, "S1", 12, 100, 1000, 5000, "2024-01-26 00:00:00"),
    (2, "S2", 10, None, 1001, 5001, "2024-01-05 00:00:00"),
    (3, "S3", 99, 101, None, None, "2024-01-25 23:59:59"),
    (4, "S4", 10, 100, 1000, 5000, None),
    (5, "S5", 13, 101, 1002, 5001, "2024-01-01 00:00:00"),
]


def subs_hist(spark: SparkSession) -> DataFrame:
    rows = [(k, i, s, t, None, None, None, None, None, None, a, None, None, c, ts(v))
            for k, i, s, t, a, c, v in _SUBS]
    return spark.createDataFrame(rows, SUBS_SCHEMA)


def stts_hist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(10, "ACTIVE", ts("2024-01-01 00:00:00")), (11, "BARRED", ts("2024-01-01 00:00:00")),
         (11, "SUSPENDED", ts("2024-01-15 00:00:00")), (12, "CLOSED", ts("2024-01-01 00:00:00")),
         (13, None, ts("2024-01-01 00:00:00"))],
        "subs_stts_key int, subs_stts_ds string, ecf_nsrt_ts timestamp")


def cust_type_hist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(100, "RESIDENTIAL", ts("2024-01-01 00:00:00")),
         (101, "BUSINESS", ts("2024-02-01 00:00:00"))],
        "cust_type_key int, cust_type_ds string, ecf_nsrt_ts timestamp")


def acct_hist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(1000, "A1000", 1, "X0", ts("2024-01-01 00:00:00")),
         (1001, "A1001", 1, "X1", ts("2024-01-02 00:00:00")),
         (1001, "A1001B", 1, "X1", ts("2024-01-02 00:00:00"))],
        "acct_key int, acct_id string, acct_stts_key int, xtrn_id string, ecf_nsrt_ts timestamp")


def cust_hist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(5000, "C5000", 1, ts("2024-01-01 00:00:00")),
         (5001, "C5001", 1, ts("2024-01-01 00:00:00"))],
        "cust_key int, cust_id string, cust_stat_key int, ecf_nsrt_ts timestamp")


def usage(spark: SparkSession) -> DataFrame:
    rows = [
        (1, "2024-01-24 10:00:00", "D", 100, 10, 110, 1),
        (1, "2024-01-24 11:00:00", "D", 50, None, 50, 1),
        (1, "2024-01-25 09:00:00", "D", 150, 10, 160, 2),
        (1, "2024-01-26 09:00:00", "D", 7, 7, 14, 1),
        (1, "2024-01-23 09:00:00", "V", 900, 900, 900, 9),
        (2, "2024-01-25 00:00:00", "D", None, None, None, None),
        (2, "2023-12-16 00:00:00", "D", 20, 2, 22, 1),
        (2, "2023-12-15 23:59:59", "D", 999, 999, 999, 9),
        (3, None, "D", 1, 1, 1, 1),
    ]
    return spark.createDataFrame(
        [(k, ts(t), c, d, u, a, r) for k, t, c, d, u, a, r in rows],
        "subs_key int, evnt_strt_ts timestamp, serv_type_cd string, dwld_vlum_qty bigint, "
        "upld_vlum_qty bigint, actl_data_vlum_qty bigint, rnd_unit_cnt bigint")


D = dt.date

EXPECTED_ASOF_SUBS = {(1, 11), (2, 10), (3, 99), (5, 13)}

EXPECTED_DAILY = [
    (1, 0, 0, 0, 0, D(2024, 1, 23)), (1, 150, 10, 160, 2, D(2024, 1, 24)),
    (1, 150, 10, 160, 2, D(2024, 1, 25)), (1, 7, 7, 14, 1, D(2024, 1, 26)),
    (2, 20, 2, 22, 1, D(2023, 12, 16)), (2, 0, 0, 0, 0, D(2024, 1, 25)),
]

EXPECTED_MONTHLY = [
    (1, 307, 27, 334, 5, "2024-01-01"), (2, 20, 2, 22, 1, "2023-12-01"),
    (2, 0, 0, 0, 0, "2024-01-01"),
]
EXPECTED_MONTHLY_ALIGNED = [
    (1, 307, 27, 334, 5, "2024-01-01"), (2, 1019, 1001, 1021, 10, "2023-12-01"),
    (2, 0, 0, 0, 0, "2024-01-01"),
]

EXPECTED_ENRICHED = [
    (1, 11, "SUSPENDED", 100, "RESIDENTIAL", "2024-01-25"),
    (2, 10, "ACTIVE", None, "~UNK", "2024-01-25"),
    (3, 99, "~UNK", 101, "~UNK", "2024-01-25"),
    (5, 13, "~UNK", 101, "~UNK", "2024-01-25"),
]

# subs_key, subs_stts_ds, cust_type_ds, acct_id, cust_id, dwld, upld, actl, rnd
EXPECTED_AS_WRITTEN = [
    (1, "SUSPENDED", "RESIDENTIAL", "A1000", "C5000", 0, 0, 0, 0),
    (1, "SUSPENDED", "RESIDENTIAL", "A1000", "C5000", 7, 7, 14, 1),
    (1, "SUSPENDED", "RESIDENTIAL", "A1000", "C5000", 300, 20, 320, 4),
    (2, "ACTIVE", "~UNK", "A1001", "C5001", 0, 0, 0, 0),
    (2, "ACTIVE", "~UNK", "A1001", "C5001", 20, 2, 22, 1),
    (2, "ACTIVE", "~UNK", "A1001B", "C5001", 0, 0, 0, 0),
    (2, "ACTIVE", "~UNK", "A1001B", "C5001", 20, 2, 22, 1),
    (3, "~UNK", "~UNK", None, None, None, None, None, None),
    (5, "~UNK", "~UNK", None, "C5001", None, None, None, None),
]
EXPECTED_PER_SUBSCRIBER = [
    (1, "SUSPENDED", "RESIDENTIAL", "A1000", "C5000", 307, 27, 334, 5),
    (2, "ACTIVE", "~UNK", "A1001", "C5001", 20, 2, 22, 1),
    (2, "ACTIVE", "~UNK", "A1001B", "C5001", 20, 2, 22, 1),
    (3, "~UNK", "~UNK", None, None, None, None, None, None),
    (5, "~UNK", "~UNK", None, "C5001", None, None, None, None),
]
PROFILE_CHECKED = ("subs_key", "subs_stts_ds", "cust_type_ds", "acct_id", "cust_id",
                   "dwld_vlum_qty", "upld_vlum_qty", "actl_data_vlum_qty", "data_rnd_unit_qty")


def sorted_rows(df: DataFrame, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def as_sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
