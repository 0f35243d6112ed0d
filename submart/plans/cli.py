"""Command line for the three jobs.

    python -m submart JOB RUN_DATE [RUN_DATE_FORMAT [LOG_LEVEL]]
                      (--root PATH | --database DB) [--current-date YYYY-MM-DD]
                      [--mode as_written|per_subscriber] [--master URL]
                      [--grain DAILY|MONTHLY] [--window-days N] [--drop-duplicates]
                      [--partition-column NAME] [--usage-from D] [--usage-to D]
                      [--register-in DB] [--buckets N]

``JOB`` is ``usage``, ``enriched``, ``profile`` or ``all``.  The positional
arguments follow the jobs' own: the run date, its pattern (Spark's datetime
pattern letters, e.g. ``dd/MM/yyyy``) and a log level.
"""

from __future__ import annotations

import argparse
import datetime as dt

from ..session import build_session
from .pipelines import JOBS, USAGE_WINDOW_DAYS, Layout, parse_context

#: Log levels a job accepts
LOG_LEVELS = ("ALL", "TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL", "OFF")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="submart", description=__doc__.split("\n\n")[0])
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("run_date")
    p.add_argument("run_date_format", nargs="?", default="yyyy-MM-dd")
    p.add_argument("log_level", nargs="?", default="WARN", type=str.upper, choices=LOG_LEVELS)
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--root", help="folder holding the tables as <root>/<table>")
    where.add_argument("--database", help="catalog database holding the tables")
    p.add_argument("--format", default="parquet")
    p.add_argument("--register-in", help="with --root: database that gets a table over each target, partitions included")
    p.add_argument("--buckets", type=int, help="with --database: store usage and enrichment in N buckets of the subscriber key")
    p.add_argument("--current-date", type=dt.date.fromisoformat,
                   help="the date that picks active over history reads (default: today)")
    p.add_argument("--mode", default="as_written", choices=("as_written", "per_subscriber"))
    p.add_argument("--grain", default="DAILY", type=str.upper, choices=("DAILY", "MONTHLY"),
                   help="grain of the usage job")
    p.add_argument("--window-days", type=int, default=USAGE_WINDOW_DAYS,
                   help="days before the run date that the usage job restates")
    p.add_argument("--drop-duplicates", action="store_true",
                   help="drop equal rows of the usage source first")
    p.add_argument("--partition-column", help="DATE partition of the usage source, to skip folders by")
    p.add_argument("--usage-from", type=dt.date.fromisoformat, help="first usage day the profile sums")
    p.add_argument("--usage-to", type=dt.date.fromisoformat, help="last usage day the profile sums")
    p.add_argument("--master", default=None)
    p.add_argument("--cluster", action="store_true",
                   help="apply the large-cluster sizing (submart.session.CLUSTER_CONF)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(master=args.master, app_name=f"submart-{args.job}",
                          cluster=args.cluster)
    spark.sparkContext.setLogLevel(args.log_level)
    ctx = parse_context(spark, args.run_date, args.run_date_format, args.current_date)
    layout = Layout(root=args.root, database=args.database, format=args.format,
                    register_in=args.register_in, buckets=args.buckets)
    usage = {"grain": args.grain, "window_days": args.window_days, "drop_duplicates": args.drop_duplicates,
             "partition_column": args.partition_column}
    profile = {"usage_from": args.usage_from, "usage_to": args.usage_to}
    job = JOBS[args.job]
    if args.job == "all":
        job(spark, layout, ctx, mode=args.mode, usage=usage, profile=profile)
    elif args.job == "profile":
        job(spark, layout, ctx, mode=args.mode, **profile)
    elif args.job == "usage":
        job(spark, layout, ctx, **usage)
    else:
        job(spark, layout, ctx)
    return 0
