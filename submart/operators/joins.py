"""Left lookup joins that stay fast when a key is hot.

Every join in the jobs is a left outer equi-join of a large table onto a
lookup (status, customer type, account, customer, snapshot, usage).  Two
things decide its plan at scale:

* **A lookup of proven size is broadcast.**  The proof is an exact row
  count of the stored rows the lookup is read from, and, where they are few
  enough, their bytes; a lookup over either bound is never broadcast.  The count projects no column (``ReadSchema:
  struct<>``: Parquet answers from row-group metadata) and is combined
  map-side (one partial count per task crosses the network), so it stays
  cheap on a huge table; all of a query's counts run as one Spark job.
  (``limit(n + 1).count()`` would not: it funnels up to ``n + 1`` rows *per
  split* into a single task.)
* **Otherwise hot keys are salted.**  A lookup key may carry a third of the
  left rows (one corporate account, one status code, NULL).  In a plain
  shuffled join all of them land in one task.  ``salted_left_join`` counts
  left rows per key (a map-side combined aggregate), takes the hottest keys
  over a threshold (a bounded top-k, so its broadcast is bounded by
  construction), spreads each hot key's left rows over several salt values
  by a hash of the row and its input split (so even identical copies
  spread), and copies only those keys' lookup rows once per salt.  Keys below the threshold join as usual, so the result is exact
  for every key.  NULL keys, which never match, are spread by the same
  hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import salt_hash

#: Spark conf keys (read from the session) and their defaults
BROADCAST_MAX_ROWS_CONF = "submart.broadcast.maxRows"
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES_CONF = "submart.broadcast.maxBytes"
BROADCAST_MAX_BYTES = 256 << 20
HOT_KEY_ROWS_CONF = "submart.skew.hotKeyRows"
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS_CONF = "submart.skew.maxHotKeys"
MAX_HOT_KEYS = 10_000
MAX_SALT_CONF = "submart.skew.maxSalt"
# a hot key gets one salt per hotKeyRows rows, up to this many; the lookup
# rows copied for salting total about (all left rows / hotKeyRows), so the
# cap bounds task size, not cost: 1/3 of 1e11 rows in 4096 pieces is ~8e6 each
MAX_SALT = 4096


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def row_counts(probes: dict[str, DataFrame]) -> dict[str, int]:
    """Exact row counts of several DataFrames in one Spark job.

    Each DataFrame is projected to a constant tag (no column is read) and
    one grouped count runs over their union: every task sends one partial
    count per tag, and the driver receives one row per DataFrame.
    """
    if not probes:
        return {}
    tagged = [df.select(F.lit(name).alias("__probe")) for name, df in probes.items()]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionAll(t)
    counts = {r["__probe"]: r["n"] for r in
              union.groupBy("__probe").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {name: int(counts.get(name, 0)) for name in probes}


def row_count(df: DataFrame) -> int:
    return row_counts({"df": df})["df"]


def row_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: text and binary as measured, other types by their default size."""
    fixed, measured = 0, F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured = measured + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            measured = measured + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            fixed += 8
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(measured), F.lit(0))).first()
    return int(size) + int(n) * fixed


def stored_bytes(df: DataFrame) -> int:
    """What Spark's plan statistics say ``df`` reads (file sizes, no job); an estimate, so it only picks
    between plans of equal results and never forces a broadcast."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


#: bytes of a stored row at least, as a rule: short keys and times, compressed
MIN_ROW_BYTES = 16


#: what Spark takes for the size of rows it has no statistics of
UNKNOWN_BYTES = (1 << 63) - 1


def estimated_rows(df: DataFrame) -> int:
    """How many rows a table of its bytes may well hold; rows without statistics are counted."""
    size = stored_bytes(df)
    return row_count(df) if size >= UNKNOWN_BYTES else size // MIN_ROW_BYTES


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` is within the bounds of rows and bytes (counted, not estimated)."""
    return fits_broadcast_many({"df": df}, max_rows)["df"]


def fits_broadcast_many(probes: dict[str, DataFrame], max_rows: int | None = None,
                        counts: dict[str, int] | None = None) -> dict[str, bool]:
    """``fits_broadcast`` for several tables: one job counts rows, and each
    table that has few enough is measured in bytes, as wide rows count too."""
    if not probes:
        return {}
    any_df = next(iter(probes.values()))
    if max_rows is None:
        max_rows = _conf_int(any_df, BROADCAST_MAX_ROWS_CONF, BROADCAST_MAX_ROWS)
    max_bytes = _conf_int(any_df, BROADCAST_MAX_BYTES_CONF, BROADCAST_MAX_BYTES)
    counts = row_counts(probes) if counts is None else counts
    return {name: counts[name] <= max_rows and row_bytes(df) <= max_bytes for name, df in probes.items()}


HK, NB = "__hot_key", "__hot_salts"


def _limits(df: DataFrame, hot_key_rows, max_hot_keys, max_salt) -> tuple[int, int, int]:
    return (hot_key_rows or _conf_int(df, HOT_KEY_ROWS_CONF, HOT_KEY_ROWS),
            max_hot_keys or _conf_int(df, MAX_HOT_KEYS_CONF, MAX_HOT_KEYS),
            max_salt or _conf_int(df, MAX_SALT_CONF, MAX_SALT))


def _top_hot(counts: DataFrame, key: str, hot_key_rows: int, max_hot_keys: int,
             max_salt: int, include_null: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    # at most max_hot_keys rows by construction; the order is total so every
    # use of the list sees the same keys
    keep = F.col("__n") > F.lit(hot_key_rows)
    if not include_null:
        keep = keep & F.col(key).isNotNull()
    return F.broadcast(
        counts.where(keep)
              .orderBy(F.col("__n").desc(), F.col(key))
              .limit(max_hot_keys)
              .select(F.col(key).alias(HK),
                      F.least(F.ceil(F.col("__n") / F.lit(hot_key_rows)),
                              F.lit(max_salt)).cast("int").alias(NB), *extra))


def hot_keys(source: DataFrame, keys: list[str], hot_key_rows: int | None = None,
             max_hot_keys: int | None = None, max_salt: int | None = None,
             include_null: bool = False) -> dict[str, DataFrame]:
    """For each key column, its hottest values and how many salts each gets.

    One pass over ``source`` for all keys: a GROUPING SETS aggregate (one set
    per key, combined map-side), whose shuffle every list below reuses.  Each
    list is a bounded top-k, ready to broadcast.  ``include_null`` lets NULL
    be a hot key too (where NULL keys form one group, as in a window).
    """
    rows, top, salt = _limits(source, hot_key_rows, max_hot_keys, max_salt)
    if len(keys) == 1:
        counts = source.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("__n"))
        return {keys[0]: _top_hot(counts, keys[0], rows, top, salt, include_null)}
    flags = [F.grouping(k).alias(f"__g{i}") for i, k in enumerate(keys)]
    counts = (source.groupingSets([[k] for k in keys], *keys)
                    .agg(F.count(F.lit(1)).alias("__n"), *flags))
    return {k: _top_hot(counts.where(F.col(f"__g{i}") == 0), k, rows, top, salt, include_null)
            for i, k in enumerate(keys)}


#: buckets that keys are hashed into to find hot ones: a bound on every hot list, whatever the number of keys
KEY_BUCKETS = 1 << 20


def key_bucket(key):
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def salts_of(counted: DataFrame, bucket: str, n, hot_key_rows: int, max_salt: int) -> DataFrame:
    """``bucket, __salts`` for buckets of more than ``hot_key_rows``: at most one row per bucket."""
    return (counted.groupBy(bucket).agg(n.alias("__rows")).where(F.col("__rows") > hot_key_rows)
            .select(bucket, F.least(F.ceil(F.col("__rows") / F.lit(hot_key_rows)), F.lit(max_salt)).cast("int").alias("__salts")))


def hot_buckets(stored: DataFrame, keys: dict[str, T.DataType | None], hot_key_rows: int | None = None,
                max_salt: int | None = None) -> dict[str, DataFrame]:
    """For each key column, a sketch of its frequent values: hash buckets that hold many rows, and their salts.

    ``keys`` gives the type a key is compared in (``None``: its own).  One pass
    over the stored key columns counts at most ``KEY_BUCKETS`` buckets a key,
    combined map-side, and nothing of the join's inputs is computed for it.  A
    hot value makes its bucket hot; a value that shares the bucket is spread as
    well, which costs copies and changes no result.  The counts are exact, so
    both sides of a join see one list even when a task is run again.  NULL is
    left out: it matches nothing.
    """
    rows, _, salt = _limits(stored, hot_key_rows, None, max_salt)
    names = {k: f"__b{i}" for i, k in enumerate(keys)}
    cut = stored.select(*[F.when(F.col(k).isNotNull(), key_bucket(F.col(k) if t is None else F.col(k).try_cast(t)))
                          .alias(names[k]) for k, t in keys.items()])
    if len(names) > 1:
        cut = (cut.groupingSets([[n] for n in names.values()], *names.values())
                  .agg(F.count(F.lit(1)).alias("__n"), *[F.grouping(n).alias(f"{n}g") for n in names.values()]))
    out = {}
    for k, n in names.items():
        one = cut.where(F.col(f"{n}g") == 0) if len(names) > 1 else cut.withColumn("__n", F.lit(1))
        one = one.where(F.col(n).isNotNull()).select(F.col(n).alias("__bucket"), "__n")
        out[k] = F.broadcast(salts_of(one, "__bucket", F.sum("__n"), rows, salt)
                             .select(F.col("__bucket").alias(HK), F.col("__salts").alias(NB)))
    return out


def common_key_type(left: DataFrame, right: DataFrame, left_key: str, right_key: str):
    """The type two keys of different types are compared in; ``None`` when they have one type.

    Text against a number is compared as a number (text that is none matches
    nothing); other pairs as Spark would widen them.
    """
    lt, rt = left.schema[left_key].dataType, right.schema[right_key].dataType
    if lt == rt:
        return None
    texts, numbers = [[t for t in (lt, rt) if isinstance(t, kind)] for kind in (T.StringType, T.NumericType)]
    if texts and numbers:
        return T.LongType() if isinstance(numbers[0], T.IntegralType) else numbers[0]
    null = F.lit(None)
    return (left.sparkSession.range(0).select(F.coalesce(null.cast(lt), null.cast(rt)).alias("k"))
            .schema["k"].dataType)


def salted_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     hot_keys_from: DataFrame | None = None, salt_by: list[str] | None = None,
                     hot: DataFrame | None = None, hot_key_rows: int | None = None,
                     max_hot_keys: int | None = None, max_salt: int | None = None,
                     buckets: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with hot keys split.

    Column names of ``left`` and ``right`` must not overlap.  Hot keys are
    counted in ``hot_keys_from`` (default ``left``), which must hold
    ``left_key``: pass the narrow table the key comes from when ``left`` is
    itself the output of other joins, so they are not planned twice; or pass
    ``hot`` from ``hot_keys``.  Which keys count as hot changes only the
    cost, never the result.  ``salt_by`` names the columns hashed to pick a
    row's salt (default: all of ``left``); a row identifier such as the
    subscriber key is enough and cheaper.  ``buckets`` from ``hot_buckets``
    (counted in the type the keys are compared in) takes the place of ``hot``.
    """
    _, _, max_salt = _limits(left, hot_key_rows, max_hot_keys, max_salt)
    if hot is None and buckets is None:
        source = left if hot_keys_from is None else hot_keys_from
        hot = hot_keys(source, [left_key], hot_key_rows, max_hot_keys, max_salt)[left_key]
    common = common_key_type(left, right, left_key, right_key)
    if common is not None:
        # one type on all sides: two hot texts can be one number, and must be one hot key
        kept = [c for c in left.columns] + [c for c in right.columns]
        left = left.withColumn("__lkey", F.col(left_key).try_cast(common))
        right = right.withColumn("__rkey", F.col(right_key).try_cast(common))
        if hot is not None:
            hot = F.broadcast(hot.groupBy(F.col(HK).try_cast(common).alias(HK)).agg(F.max(NB).alias(NB))
                              .where(F.col(HK).isNotNull()))
        return salted_left_join(left, right, "__lkey", "__rkey", None, salt_by or [left_key], hot,
                                hot_key_rows, max_hot_keys, max_salt, buckets).select(*kept)
    ls, rs = "__lsalt", "__rsalt"
    h = salt_hash(list(salt_by or left.columns))
    spread = F.pmod(h, F.lit(max_salt)).cast("int")
    lsalt = (F.when(F.col(NB).isNotNull(), F.pmod(h, F.col(NB)).cast("int"))
              .when(F.col(left_key).isNull(), spread)
              .otherwise(F.lit(0)))
    listed, what = (buckets, key_bucket) if buckets is not None else (hot, lambda key: key)
    lhs = (left.join(listed, what(F.col(left_key)) == F.col(HK), "left")
               .withColumn(ls, lsalt).drop(HK, NB))
    rhs = (right.join(listed, what(F.col(right_key)) == F.col(HK), "left")
                .withColumn(rs, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(NB), F.lit(1)) - 1)))
                .drop(HK, NB))
    cond = (F.col(left_key) == F.col(right_key)) & (F.col(ls) == F.col(rs))
    return lhs.join(rhs, cond, "left").drop(ls, rs)


#: a lookup joined plainly, which AQE broadcasts on the size it measures
MEASURED = "measured"


def measured_broadcast(stored: DataFrame) -> bool:
    """Whether a lookup's stored bytes are so far under AQE's broadcast threshold that it will surely be broadcast
    once measured.  Asks the plan's statistics and settings only; the broadcast itself waits for the measured size."""
    conf = stored.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        return False
    limit = conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or conf.get("spark.sql.autoBroadcastJoinThreshold")
    size = _bytes(limit)
    rows = _conf_int(stored, BROADCAST_MAX_ROWS_CONF, BROADCAST_MAX_ROWS)
    return 0 <= MEASURED_FACTOR * stored_bytes(stored) <= size and estimated_rows(stored) <= rows


#: how much a stored lookup may grow in memory and still be under the threshold
MEASURED_FACTOR = 8
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(text: str) -> int:
    """A size setting (``64MB``, ``-1``) in bytes."""
    digits = text.strip().lower().rstrip("kmgb")
    return int(digits) * _UNITS[text.strip().lower()[len(digits):]]


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                small: bool | str | None = None, probe: DataFrame | None = None,
                hot_keys_from: DataFrame | None = None,
                salt_by: list[str] | None = None, hot: DataFrame | None = None,
                buckets: DataFrame | None = None) -> DataFrame:
    """Left join onto a lookup: broadcast when proven small, else salted.

    ``probe`` holds the stored rows ``right`` is read from; its row count
    decides ``small`` when the caller has not.  Without a probe ``right``
    itself is counted.  ``MEASURED`` leaves the broadcast to AQE.
    """
    if small is None:
        small = fits_broadcast(right if probe is None else probe)
    if small:
        common = common_key_type(left, right, left_key, right_key)
        lk, rk = F.col(left_key), F.col(right_key)
        if common is not None:
            lk, rk = lk.try_cast(common), rk.try_cast(common)
        return left.join(right if small == MEASURED else F.broadcast(right), lk == rk, "left")
    return salted_left_join(left, right, left_key, right_key, hot_keys_from, salt_by, hot, buckets=buckets)
