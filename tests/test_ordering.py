"""Skew-safe ordered helpers equal plain windows, also with a hot key that
holds a third of all rows and with no key at all."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import ordering


def _frame(spark):
    # 3000 rows; key 'hot' holds 1000 of them; t is a total order per key.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 37).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 3001).alias("t"), (F.col("id") % 11).alias("v"), "id")
    return df


def test_row_number_keyed_and_global(spark):
    df = _frame(spark)
    got = ordering.row_number(df, ["k"], ["t", "id"], out="rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.join(ref, "id").where(F.col("rn") != F.col("rn2")).count() == 0
    g = ordering.row_number(df, [], ["t", "id"], out="rn")
    gref = df.withColumn("rn2", F.row_number().over(Window.orderBy("t", "id")))
    assert g.join(gref, "id").where(F.col("rn") != F.col("rn2")).count() == 0
    assert g.count() == 3000


def test_lag_keyed(spark):
    df = _frame(spark)
    got = ordering.lag(df, ["k"], ["t", "id"], ["v", "t"])
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.lag("v").over(w).alias("pv"), F.lag("t").over(w).alias("pt"))
    bad = got.join(ref, "id").where(~F.col("prev_v").eqNullSafe(F.col("pv"))
                                    | ~F.col("prev_t").eqNullSafe(F.col("pt")))
    assert bad.count() == 0


def test_running_sum_and_max(spark):
    df = _frame(spark)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("v").over(w).alias("s2"), F.max("v").over(w).alias("m2"))
    s = ordering.running(df, ["k"], ["t", "id"], "v", "s")
    m = ordering.running(df, ["k"], ["t", "id"], "v", "m", how="max")
    j = s.join(m.select("id", "m"), "id").join(ref, "id")
    assert j.where((F.col("s") != F.col("s2")) | (F.col("m") != F.col("m2"))).count() == 0


def _ties(spark):
    """9,000 rows at one time, among a few others, and a NULL time."""
    return spark.range(9020).select(
        F.when(F.col("id") == 9019, F.lit(None)).when(F.col("id") < 9000, F.timestamp_seconds(F.lit(1000)))
        .otherwise(F.timestamp_seconds(F.col("id") * 7)).alias("t"),
        (F.col("id") * 101).alias("offset"), (F.col("id") % 5).cast("string").alias("k"), "id")


def test_rows_of_one_time_are_split(spark):
    seg = ordering.segmented(_ties(spark), [], ["t", "offset"])
    sizes = [r["count"] for r in seg.groupBy(ordering.SEG).count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 9020 / 10


def test_ties_and_null_times_equal_plain_windows(spark):
    df = _ties(spark)
    for keys in ([], ["k"]):
        w = Window.partitionBy(*keys).orderBy("t", "offset")
        ref = df.select("id", F.row_number().over(w).alias("n2"), F.lag("id").over(w).alias("p2"),
                        F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s2"))
        got = ordering.row_number(df, keys, ["t", "offset"], out="n") \
            .join(ordering.lag(df.withColumn("p", F.col("id")), keys, ["t", "offset"], ["p"]).select("id", "prev_p"), "id") \
            .join(ordering.running(df, keys, ["t", "offset"], "id", "s").select("id", "s"), "id").join(ref, "id")
        assert got.count() == 9020
        assert got.where("n <> n2 OR NOT prev_p <=> p2 OR s <> s2").count() == 0


def test_null_keys_keep_their_rows(spark):
    df = _ties(spark).withColumn("k", F.when(F.col("k") != "3", F.col("k")))
    w = Window.partitionBy("k").orderBy("t", "offset")
    got = ordering.row_number(df, ["k"], ["t", "offset"], out="n") \
        .join(df.select("id", F.row_number().over(w).alias("n2")), "id")
    assert got.count() == 9020 and got.where("n <> n2").count() == 0


def test_keyed_collect_with_ties_and_gaps(spark):
    from tidewater.operators import stateful
    df = spark.range(4000).select(
        F.timestamp_seconds(F.floor(F.col("id") / 300) * 13 + F.when(F.col("id") > 2500, F.col("id") % 300).otherwise(0))
        .alias("timestamp"), (F.col("id") * 211).alias("offset"), F.lit(0).alias("partition"))
    got = stateful.keyed_collect(df, F.col("offset"), max_items=50)
    w = Window.orderBy("timestamp", "offset")
    gap = F.unix_seconds("timestamp") - F.unix_seconds(F.lag("timestamp").over(w))
    flat = df.withColumn("s", F.when(gap.isNull() | (gap > 10), 1).otherwise(0)).withColumn("session", F.sum("s").over(w))
    ref = flat.withColumn("rn", F.row_number().over(Window.partitionBy("session").orderBy("timestamp", "offset"))) \
        .select("session", F.floor((F.col("rn") - 1) / 50).alias("chunk"), F.col("offset").alias("item"))
    mine = got.select("session", "chunk", F.explode("items").alias("item"))
    assert got.select("session").distinct().count() > 5
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_cumulative_rate_two_level_equals_global_rank(spark):
    from tidewater.operators import aggregates
    from tidewater.sources import fixture
    raw = fixture.raw_topic(spark, "/root/testdata/sf0.001")
    got = {r["n"]: r["arrival_ts"] for r in aggregates.cumulative_rate(raw, every=7).collect()}
    w = Window.orderBy("timestamp", "offset", "partition")
    ref = raw.select("timestamp", F.row_number().over(w).alias("n")).where(F.col("n") % 7 == 0)
    want = {r["n"]: r["timestamp"] for r in ref.collect()}
    assert got == want and len(want) > 100
