"""Reading a source "as of" a run date.

Four readings, picked from the source's SCD kind and from whether the run
date is today:

=============  ==========================================================
R1 full        every row of a current-only table
R2 window      rows whose day is at most ``N`` days before the run date;
               inclusive lower bound, **no** upper bound, NULL time dropped
R3 active      the whole active table (run date == current date)
R4 as-of       history rows whose day is <= the run date, then the newest
               version per key by ``RANK``; ties all survive, NULL keys form
               one group, the ``rnk`` column stays
R5 snapshot    rows whose snapshot column equals the run date
=============  ==========================================================

All are declarative, so Catalyst pushes the day bounds into the Parquet scan
(``to_date(ts) >= d`` becomes ``ts >= d``) and prunes columns through the
``SELECT *``.  R4 has two plans with the same rows.  A history that one task
could hold is ranked, by a partial ``WindowGroupLimit`` ahead of the shuffle.
A larger one is read without a rank: the newest time per key by a narrow
aggregate, then a semi-join on key and time, behind a Bloom filter of fixed
size (see ``newest_versions``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_of, days_before
from ..functions.exprs import salt_hash
from ..specs import RunContext, ScdKind, SourceSpec


def load(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table``) or a path."""
    if "/" in location or location.startswith(("file:", "s3", "hdfs:", "gs:", "abfs")):
        return spark.read.format(fmt).load(location)
    return spark.table(location)


def scd1_full(df: DataFrame) -> DataFrame:
    """R1: every row, no filter."""
    return df


def scd1_window(df: DataFrame, ts_column: str, run_date: dt.date, days: int,
                partition_column: str | None = None, until: dt.date | None = None) -> DataFrame:
    """R2: ``to_date(ts) >= run_date - days``.

    Rows after the run date stay unless ``until`` is given.  ``partition_column``
    (a stored ``DATE`` partition equal to ``to_date(ts)``) gets the same bound so
    whole partitions are skipped at listing time.
    """
    start = days_before(run_date, days)
    out = df.where(day_of(ts_column) >= start)
    if until is not None:
        out = out.where(day_of(ts_column) <= F.lit(until))
    if partition_column:
        out = out.where(F.col(partition_column) >= start)
        if until is not None:
            out = out.where(F.col(partition_column) <= F.lit(until))
    return out


def scd4_active(df: DataFrame) -> DataFrame:
    """R3: the active table as it is (one row per key is assumed, not enforced)."""
    return df


def scd4_asof(hist: DataFrame, keys: list[str] | tuple[str, ...], ts_column: str,
              run_date: dt.date, tie_break: list[str] | tuple[str, ...] | None = None,
              rank_column: str = "rnk", skew_safe: bool | None = None,
              hot_key_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """R4: newest version per key as of the run date.

    ``RANK`` keeps every version tied on the newest time.  ``tie_break``
    orders the tied versions further, then by all other columns that have an
    order, and keeps one per key: the same one whatever the table's size.
    The result has the history's columns (less one named ``rank_column``) and
    ``rank_column``.

    ``skew_safe`` takes the plan for large histories (``newest_versions``);
    ``False`` is the window.  Both give the same rows.  ``None`` (the default)
    decides by how many rows the history may hold (``rows``, or else an upper
    estimate from its files' bytes, without a job): at most ``hot_key_rows``
    rows cannot hold a hot key.  With ``tie_break`` no key is hot: each input
    split sends one row per key.
    """
    from ..operators.joins import HOT_KEY_ROWS, HOT_KEY_ROWS_CONF, _conf_int, estimated_rows

    hist = hist.select(*[F.col(c) for c in hist.columns if c != rank_column])
    eligible = hist.where(day_of(ts_column) <= F.lit(run_date))
    keys = list(keys)
    order: list[Column] = [F.col(ts_column).desc()]
    ranker = F.rank()
    if tie_break:
        known = {*keys, ts_column, *tie_break}
        rest = [f.name for f in hist.schema.fields if f.name not in known and _orderable(f.dataType)]
        order += [F.col(c).desc() for c in (*tie_break, *rest)]
        ranker = F.row_number()
    elif skew_safe is None:
        limit = hot_key_rows or _conf_int(hist, HOT_KEY_ROWS_CONF, HOT_KEY_ROWS)
        skew_safe = (estimated_rows(hist) if rows is None else rows) > limit
    if skew_safe and not tie_break:
        return newest_versions(eligible, keys, ts_column, hot_key_rows).withColumn(rank_column, F.lit(1))
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (eligible.withColumn(rank_column, ranker.over(w))
                    .where(F.col(rank_column) == 1))


def _orderable(t: T.DataType) -> bool:
    """Whether values of a type have an order (and a hash)."""
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


#: the Bloom filter of (key, newest time): groups of 512 words of 64 bits, 2**27
#: bits (16 MB) by default, whatever the history's size
FILTER_GROUPS_CONF = "submart.asof.filterGroups"
FILTER_GROUPS = 1 << 12
FILTER_WORDS = 512


def newest_filter(newest: DataFrame, pair: Column, groups: int) -> DataFrame:
    """A Bloom filter with one hash as a table ``__group, __bits`` of at most ``groups`` rows.

    A pair's hash names its group, a word of the group and a bit of the word.
    Bits are or-ed per word and words packed per group, each by a grouped
    aggregate; nothing is collected.
    """
    bits = newest.select(F.shiftright(pair, 15).alias("h"), F.pmod(pair, F.lit(1 << 15)).cast("int").alias("b"))
    words = (bits.groupBy(F.pmod("h", F.lit(groups)).cast("int").alias("__group"), F.shiftright("b", 6).alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, b & 63)")).alias("v")))
    packed = words.groupBy("__group").agg(F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))
    return packed.select("__group", F.transform(F.sequence(F.lit(0), F.lit(FILTER_WORDS - 1)),
                                                lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint")))
                         .alias("__bits"))


def newest_versions(eligible: DataFrame, keys: list[str], ts_column: str,
                    hot_key_rows: int | None = None) -> DataFrame:
    """Every row at its key's newest time: R4 for a large history, without a rank.

    1. One aggregate over the key and time columns alone, combined map-side,
       gives each key's newest time and its number of rows: the one keyed
       shuffle of the table, of narrow rows.
    2. A Bloom filter of (key, newest time), of one size whatever the table's,
       is broadcast to the wide scan.  Nearly all older versions go there,
       before any shuffle.  With more keys than it has bits for it passes more
       rows; it never loses one.
    3. A left semi-join on key and time keeps exactly the rows at the newest
       time, ties and all.  A key with many rows is spread: keys are hashed
       into a fixed number of buckets, a bucket with a hot key gets a number
       of salts (a bounded table, broadcast), and only narrow rows are copied
       per salt.

    NULL keys form one group, as in the window.  A history whose versions are
    mostly newest ones shuffles those rows, as it must to be joined.
    """
    from ..operators.joins import KEY_BUCKETS, _conf_int, _limits, salts_of

    groups = _conf_int(eligible, FILTER_GROUPS_CONF, FILTER_GROUPS)
    hot, _, max_salt = _limits(eligible, hot_key_rows, None, None)
    names = [f"__key{i}" for i in range(len(keys))]
    newest = (eligible.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
                      .agg(F.max(ts_column).alias("__newest"), F.count(F.lit(1)).alias("__n")))
    pair = F.xxhash64(*names, "__newest")
    bits = newest_filter(newest, pair, groups)
    bucket = F.pmod(F.xxhash64(*names), F.lit(KEY_BUCKETS)).cast("int")
    salts = F.broadcast(salts_of(newest.where(F.col("__n") > hot).select(bucket.alias("__bucket"), "__n"), "__bucket",
                                 F.max("__n"), hot, max_salt))
    # narrow side: a copy per salt
    copies = (newest.join(salts, bucket == F.col("__bucket"), "left")
                    .select(*names, "__newest", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)).alias("__copy")))
    # wide side: the filter, then a salt
    h = F.xxhash64(*keys, ts_column)
    hashed = [f.name for f in eligible.schema.fields if _orderable(f.dataType)]
    passed = (eligible.join(F.broadcast(bits), F.pmod(F.shiftright(h, 15), F.lit(groups)).cast("int") == F.col("__group"))
                      .where(F.getbit(F.get("__bits", F.shiftright(F.pmod(h, F.lit(1 << 15)).cast("int"), 6)),
                                      F.pmod(h, F.lit(64)).cast("int")) == 1)
                      .drop("__group", "__bits"))
    spread = (passed.join(salts.withColumnsRenamed({"__bucket": "__b", "__salts": "__s"}),
                          F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int") == F.col("__b"), "left")
                    .withColumn("__salt", F.when(F.col("__s").isNotNull(), F.pmod(salt_hash(hashed), F.col("__s")).cast("int"))
                                .otherwise(F.lit(0))).drop("__b", "__s"))
    same = F.col(ts_column) == F.col("__newest")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return (spread.join(copies, same & (F.col("__salt") == F.col("__copy")), "left_semi").select(*eligible.columns))


def snapshot(df: DataFrame, snapshot_column: str, run_date: dt.date) -> DataFrame:
    """R5: the copy stamped with the run date (ISO text, as the jobs write it).

    On a partition column this becomes a ``PartitionFilter``.
    """
    return df.where(F.col(snapshot_column) == F.lit(run_date.isoformat()))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """R8: drop rows equal in every column (hash aggregate, combined map-side)."""
    return df.dropDuplicates()


def read_source(spark: SparkSession, spec: SourceSpec, ctx: RunContext,
                stored: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """R6: route a source to R1-R5, then de-duplicate, project and register.

    ``stored`` and ``rows`` are what ``stored_rows`` loaded and its count, when
    the caller has them: then nothing is loaded or counted again.
    """
    if stored is None:
        stored = stored_rows(spark, spec, ctx)
    if spec.kind is ScdKind.CURRENT_SCD1:
        if spec.window_days is None:
            df = scd1_full(stored)
        else:
            df = scd1_window(stored, spec.ts_column, ctx.run_date, spec.window_days,
                             spec.partition_column,
                             until=ctx.run_date if spec.window_until_run_date else None)
    elif spec.kind is ScdKind.DELTA_SCD4 and ctx.reads_active:
        df = scd4_active(stored)
    elif spec.kind is ScdKind.DELTA_SCD4:
        df = scd4_asof(stored, spec.keys, spec.ts_column, ctx.run_date, spec.tie_break,
                       skew_safe=spec.skew_safe, rows=rows)
    elif spec.kind is ScdKind.SNAPSHOT:
        df = snapshot(stored, spec.snapshot_column, ctx.run_date)
    else:  # pragma: no cover - ScdKind.parse rejects anything else
        raise ValueError(f"unknown SCD kind {spec.kind!r}")
    # rows equal in all columns, so before any column goes
    if spec.drop_duplicates:
        df = drop_duplicate_rows(df)
    if spec.columns:
        df = df.select(*spec.columns)
    if spec.view_name:
        df.createOrReplaceTempView(spec.view_name)
    return df


def stored_rows(spark: SparkSession, spec: SourceSpec, ctx: RunContext) -> DataFrame:
    """The stored rows a source reads from, before any window or rank.

    Its row count bounds the size of ``read_source(spec)``, so counting it
    decides a broadcast without computing the as-of read twice.
    """
    if spec.kind is ScdKind.DELTA_SCD4:
        return load(spark, spec.active if ctx.reads_active else spec.hist, spec.format)
    return load(spark, spec.location, spec.format)
