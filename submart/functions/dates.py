"""Date expressions used by the readers and the usage roll-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def parse_run_date(spark: SparkSession, text: str, fmt: str = "yyyy-MM-dd") -> dt.date:
    """Parse the run date once, at job start, with Spark's own pattern family.

    Parsing is strict: an impossible day such as ``2024-02-30`` raises
    instead of being adjusted.
    """
    value = spark.range(1).select(F.to_date(F.lit(text), fmt).alias("d")).first()["d"]
    if value is None:
        raise ValueError(f"run date {text!r} does not match {fmt!r}")
    return value


def session_today(spark: SparkSession) -> dt.date:
    """Today in the session time zone (the default ``current_date``)."""
    return spark.range(1).select(F.current_date().alias("d")).first()["d"]


def day_of(ts: str | Column) -> Column:
    """``to_date(ts)``: the calendar day of a timestamp.

    For ``TIMESTAMP`` this uses the session time zone; ``TIMESTAMP_NTZ`` has none.
    """
    return F.to_date(ts)


def days_before(run_date: dt.date, days: int) -> Column:
    """``date_add(run_date, -days)`` as a foldable literal."""
    return F.date_add(F.lit(run_date), -int(days))


def window_start(run_date: dt.date, days: int, align_month: bool = False) -> dt.date:
    """First day of a trailing window of ``days`` days ending at ``run_date``.

    With ``align_month`` the start moves back to the first of its month, so a
    monthly roll-up never restates a month it has read only in part.
    """
    start = run_date - dt.timedelta(days=int(days))
    return start.replace(day=1) if align_month else start


def month_grain(ts: str | Column) -> Column:
    """``'yyyy-MM-01'`` text for the month of a timestamp (NULL stays NULL)."""
    return F.date_format(F.trunc(F.to_date(ts), "MM"), "yyyy-MM-dd")
