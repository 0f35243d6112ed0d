"""A key holding a third of the rows, and NULL keys, must not land in one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from submart.operators.joins import hot_keys, salted_left_join

N = 30_000


def skewed(spark):
    # a third of the rows on key 7, a sixth with a NULL key, the rest spread
    return (spark.range(N)
                 .select(F.col("id").alias("row_id"),
                         F.when(F.col("id") % 3 == 0, F.lit(7))
                          .when(F.col("id") % 6 == 1, F.lit(None))
                          .otherwise(F.col("id") % 997).cast("int").alias("k")))


def lookup(spark):
    return spark.range(1000).select(F.col("id").cast("int").alias("lk"),
                                    F.concat(F.lit("v"), F.col("id")).alias("lv"))


def test_hot_key_found(spark):
    df = skewed(spark)
    hot = hot_keys(df, ["k"], hot_key_rows=1000, max_salt=64)["k"]
    got = {r["__hot_key"]: r["__hot_salts"] for r in hot.collect()}
    n7 = df.where("k = 7").count()
    assert got == {7: -(-n7 // 1000)}  # ceil: one salt per 1,000 rows


def test_salted_join_spreads_hot_and_null_keys(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        left, right = skewed(spark), lookup(spark)
        out = salted_left_join(left, right, "k", "lk", salt_by=["row_id"],
                               hot_key_rows=1000, max_salt=16)
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per_task) == N
        # unsalted, one task would get all 10,000 rows of key 7 (plus more);
        # salted, no task gets more than a tenth of all rows
        assert max(per_task) < N // 10
        plain = left.join(right, F.col("k") == F.col("lk"), "left")
        plain_tasks = [r["n"] for r in plain.groupBy(F.spark_partition_id().alias("p"))
                       .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(plain_tasks) >= N // 3  # the control: one task holds the hot key
        key = lambda r: (r.row_id, r.lk, r.lv)
        assert sorted(map(key, out.collect())) == sorted(map(key, plain.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asof_spreads_a_hot_tied_key(spark):
    import datetime as dt
    from submart.sources import scd4_asof
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        t0 = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
        # a third of the rows: key 7, all loaded at the same instant (tied);
        # a sixth: NULL key, also tied; the rest: many keys, varied times
        hist = (spark.range(N).select(
            F.col("id").alias("row_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7))
             .when(F.col("id") % 6 == 1, F.lit(None))
             .otherwise(F.col("id") % 997 + 1000).cast("int").alias("k"),
            F.when(F.col("id") % 3 == 0, t0).when(F.col("id") % 6 == 1, t0)
             .otherwise(t0 - F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 50)")).alias("ts")))
        run = dt.date(2024, 1, 2)
        salted = scd4_asof(hist, ["k"], "ts", run, hot_key_rows=500)
        plain = scd4_asof(hist, ["k"], "ts", run, skew_safe=False)
        per_task = [r["n"] for r in salted.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
        plain_tasks = [r["n"] for r in plain.groupBy(F.spark_partition_id().alias("p"))
                       .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(plain_tasks) >= N // 3          # the control: one task ranks key 7
        assert max(per_task) < N // 10             # salted: spread
        key = lambda r: (r.row_id, r.rnk)
        assert sorted(map(key, salted.collect())) == sorted(map(key, plain.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_identical_copies_of_a_hot_key_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        # 12,000 identical rows of key 7 in 16 input splits, plus other keys
        copies = spark.range(12_000).repartition(16).select(F.lit(7).alias("k"),
                                                            F.lit("same").alias("v"))
        others = spark.range(N).select((F.col("id") % 997 + 1000).cast("int").alias("k"),
                                       F.lit("other").alias("v"))
        left = copies.unionByName(others)
        out = salted_left_join(left, lookup(spark), "k", "lk", hot_key_rows=1000, max_salt=16)
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per_task) == 12_000 + N
        assert max(per_task) < 12_000 // 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_row_counts_in_one_job(spark):
    from submart.operators.joins import fits_broadcast_many, row_counts
    a, b, empty = spark.range(10), spark.range(1000), spark.range(0)
    assert row_counts({"a": a, "b": b, "e": empty}) == {"a": 10, "b": 1000, "e": 0}
    assert fits_broadcast_many({"a": a, "b": b}, max_rows=100) == {"a": True, "b": False}
