"""Hot keys: one key holding most rows must still be spread over many
window partitions / aggregation groups."""
import datetime as dt

from pyspark.sql import functions as F

from cumulus.operators import patterns as pt
from cumulus.operators.joins import positions
from cumulus.operators.sessions import sessionize_split
from cumulus.operators import layout as lay


def _hot(spark, n_hot=60000, n_other=20000):
    hot = spark.range(n_hot).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("i"))
    other = spark.range(n_other).select((F.col("id") % 100 + 2).alias("k"), F.col("id").alias("i"))
    df = hot.unionByName(other)
    return df.select("k", "i",
                     F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("i") % 365).cast("int")).alias("d"),
                     ((F.col("i") * 7919) % 13 > 3).alias("ok"))


def test_positions_spread_a_hot_key(spark):
    df = _hot(spark)
    chunk = [F.col("d"), F.floor(F.col("i") / 1024)]
    p = positions(df, ["k"], ["d", "i"], chunk, sums={"q": F.col("ok").cast("long")})
    # positions are a dense 1..n per key
    stats = p.groupBy("k").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                               F.count("*").alias("n")).filter("k = 1").collect()[0]
    assert (stats.lo, stats.hi, stats.n) == (1, 60000, 60000)
    # the hot key's rows are spread over many (key, chunk) window partitions
    sizes = df.filter("k = 1").groupBy(*chunk).count()
    assert sizes.count() > 300 and sizes.agg(F.max("count")).collect()[0][0] <= 1024
    plan = lay.plan_text(p, "simple")
    assert "Window" in plan and "_c0" in plan


def test_no_stitching_window_is_as_long_as_the_key(spark):
    """Offsets of a hot key are summed over its days, and inside a day over
    its buckets: both far fewer than the key's rows."""
    df = _hot(spark).filter("k = 1")
    per_day = df.groupBy("d", F.floor(F.col("i") / 16384).alias("b")).count().groupBy("d").count()
    days, most = per_day.agg(F.count("*"), F.max("count")).first()
    assert days <= 366 and most <= 4
    p = positions(df, ["k"], ["d", "i"], [F.col("d"), F.floor(F.col("i") / 16384)], sums={})
    windows = [x for x in lay.plan_text(p, "simple").splitlines() if "Window" in x]
    assert any("[k#" in x and "_c0#" in x and "_c1#" in x for x in windows)
    assert not any("[_c0#" in x.rsplit("],", 1)[-1] and "_c1#" in x.rsplit("],", 1)[-1] for x in windows)


def test_streak_on_hot_key_matches_single_window(spark):
    from pyspark.sql import Window
    df = _hot(spark, 20000, 2000)
    got = {r.k: r.longest_streak for r in pt.longest_streak(
        df, "k", ["d", "i"], [F.col("d"), F.floor(F.col("i") / 1024)], F.col("ok")).collect()}
    w = Window.partitionBy("k").orderBy("d", "i")
    g = df.withColumn("rn", F.row_number().over(w)).withColumn(
        "rq", F.row_number().over(Window.partitionBy("k", "ok").orderBy("d", "i")))
    ref = {r.k: r.m for r in g.filter("ok").groupBy("k", (F.col("rn") - F.col("rq")).alias("g"))
           .count().groupBy("k").agg(F.max("count").alias("m")).collect()}
    assert got == ref


def test_split_sessions_spread_a_hot_key(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.range(50000).select(F.lit("hot").alias("host"),
                                   (F.lit(base).cast("long") + F.col("id") * 61).cast("timestamp").alias("ts"))
    out = sessionize_split(df, "ts", ["host"], 60, bucket_seconds=3600)
    # every event is its own session (gaps 61 s > 60 s); work ran per hour bucket
    assert out.count() == 50000
    buckets = df.groupBy(F.floor(F.unix_seconds("ts") / 3600)).count()
    assert buckets.count() > 800


def test_every_level_of_a_streak_is_dealt_by_the_input(spark, monkeypatch):
    """Chunks that hold one row each make an aggregate as large as the rows:
    the tasks of each level grow in number with the input."""
    from cumulus.operators import joins
    size = joins.input_bytes(spark.range(1000))
    assert joins.task_count(spark.range(1000), size // 10) == 10
    monkeypatch.setattr(joins, "input_bytes", lambda df: 37 * joins.TASK_BYTES)
    df = _hot(spark, 2000, 500)
    out = pt.longest_streak(df, "k", ["d", "i"], [F.col("d"), F.col("i")], F.col("ok"))
    moved = [x for x in lay.plan_text(out, "simple").splitlines() if "Exchange" in x and "REPARTITION_BY_NUM" in x]
    assert len(moved) == 3 and all(", 37)" in x for x in moved)
