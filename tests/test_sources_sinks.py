"""Scans, sinks and connectors (S2-S4, S6, S7, S11, K1-K7, K11, F6, K8/K9 wiring)."""
import datetime as dt

import pytest

from pyspark.sql import functions as F, types as T

from cumulus.operators import layout as lay
from cumulus.plans import standins as si
from cumulus.session import scratch_path
from cumulus.sources import sinks
from cumulus.sources import tables as tb
from cumulus.streaming import streams as st


def _csv(spark, sf_small):
    path = scratch_path(spark, "csv")
    ev = tb.table(spark, sf_small, "events").select(
        "user_id", F.col("event_id").alias("device_id"), F.col("event_type").alias("host"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"))
    ev = ev.withColumn("user_id", F.when(F.col("device_id") % 10 == 0, None).otherwise(F.col("user_id")))
    ev.coalesce(1).write.option("header", True).csv(path)
    return path, ev.count()


def test_csv_three_ways(spark, sf_small):
    path, n = _csv(spark, sf_small)
    inferred = tb.read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["device_id"] in ("int", "bigint") and inferred.count() == n
    strings = tb.read_csv_strings(spark, path)
    assert all(t == "string" for c, t in strings.dtypes if c != "event_date")
    assert dict(strings.dtypes)["event_date"] == "timestamp"
    schema = T.StructType([T.StructField("user_id", T.LongType(), False),
                           T.StructField("device_id", T.LongType(), False),
                           T.StructField("host", T.StringType(), True),
                           T.StructField("event_time", T.StringType(), True)])
    good, bad = tb.read_typed(spark, path, schema)
    assert good.count() + bad.count() == n and bad.count() > 0
    assert good.filter(F.col("user_id").isNull()).count() == 0


def test_series(spark):
    assert [r.n for r in tb.int_series(spark, 1996, 1999).collect()] == [1996, 1997, 1998, 1999]
    assert tb.date_series(spark, "2024-01-30", "2024-02-02").count() == 4


def test_append_overwrite_partitions_and_upsert(spark):
    base = scratch_path(spark, "sink")
    rows = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")],
                                 "k long, v string, day string")
    sinks.append(rows, base, ["day"])
    sinks.append(rows, base, ["day"])
    assert spark.read.parquet(base).count() == 4
    sinks.overwrite_partitions(spark.createDataFrame([(3, "c", "2024-01-02")], rows.schema), base, ["day"])
    got = sorted((r.k, str(r.day)) for r in spark.read.parquet(base).collect())
    assert got == [(1, "2024-01-01"), (1, "2024-01-01"), (3, "2024-01-02")]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    up = sinks.upsert(old, new, ["k"])
    v1 = sinks.write_version(up, base + "_tbl", 1)
    assert sorted((r.k, r.v) for r in spark.read.parquet(v1).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_namespace_ctas_and_partitioned(spark):
    loc = scratch_path(spark, "ns")
    sinks.create_namespace(spark, "cumulus_test_ns", loc)
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    t = sinks.create_table_as(df, "cumulus_test_ns.ctas")
    assert t.count() == 2
    sinks.drop_table(spark, "cumulus_test_ns.ctas")
    assert not spark.catalog.tableExists("cumulus_test_ns.ctas")
    p = scratch_path(spark, "part")
    sinks.write_partitioned(df, p, ["v"], ["k"])
    assert spark.read.parquet(p).filter("v = 'x'").count() == 1


def test_compare_layouts_by_the_files_own_statistics(spark, sf_small):
    li = tb.table(spark, sf_small, "lineitem")
    out = lay.compare_layouts(spark, li, {
        "unsorted": {"files": 6},
        "clustered": {"files": 6, "by": ["l_suppkey"], "sort_within": ["l_suppkey"]}}, "l_suppkey")
    rows = {r.variant: r for r in out.collect()}
    n = li.count()
    keys = li.select("l_suppkey").distinct().count()
    for r in rows.values():
        assert (r.n_files, r.n_row_groups, r.n_rows, r.n_keys) == (6, 6, n, keys) and r.total_bytes > 0
        assert abs(r.rows_needed - n / keys) < 1e-9
    assert rows["unsorted"].rows_read > 0.99 * n  # every file may hold every supplier
    assert rows["clustered"].rows_read < 0.5 * n


def test_footers_equal_the_files(spark, sf_small):
    import glob
    import pyarrow.parquet as pq
    path = scratch_path(spark, "footers")
    tb.table(spark, sf_small, "orders").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    got = {r.file.rsplit("/", 1)[1]: r for r in tb.file_footers(df, "o_orderdate").collect()}
    files = glob.glob(path.replace("file:", "") + "/*.parquet")
    assert len(got) == len(files) == 3
    for f in files:
        t, r = pq.read_table(f), got[f.rsplit("/", 1)[1]]
        days = t["o_orderdate"].to_pylist()
        assert (r.rows, r.least, r.largest) == (len(days), min(days), max(days))
        assert r.bytes == pq.read_metadata(f).row_group(0).total_byte_size
    empty = df.limit(0)
    empty.write.parquet(path + "-none")
    assert tb.file_footers(spark.read.schema(df.schema).parquet(path + "-none"), "o_orderdate").count() == 0


def test_promises_are_checked_on_the_files(spark):
    df = spark.range(400).selectExpr("id % 7 AS k", "id AS v")
    good = {"by": ["k"], "spread": False, "sort_within": ["k", "v"], "files": 3}
    bad = {**good, "sort_within": ["v"]}
    rows = {r.variant: r for r in lay.layout_promises(spark, df, {"good": good, "spread": {**good, "spread": True}}, "k").collect()}
    assert (rows["good"].n_rows, rows["good"].n_keys, rows["good"].unsorted_rows, rows["good"].split_keys) == (400, 7, 0, 0)
    assert rows["spread"].unsorted_rows == 0 and rows["spread"].split_keys is None
    written = lay.write_variants(spark, df, {"x": bad})["x"]
    with pytest.MonkeyPatch.context() as mp:  # the files break another promise than the one they were written for
        mp.setattr(lay, "write_variants", lambda *a, **k: {"x": written})
        assert lay.layout_promises(spark, df, {"x": good}, "k").first().unsorted_rows > 0


def test_a_heavy_day_is_written_by_many_tasks(spark):
    import glob
    import os
    df = spark.range(50_000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 200 ELSE 7 END AS day", "id AS v", "uuid() AS u")
    path = scratch_path(spark, "heavy")
    sinks.write_partitioned(df, path, ["day"], ["v"], files=20)
    root = path.replace("file:", "")
    size = {f: os.path.getsize(f) for f in glob.glob(f"{root}/day=*/*.parquet")}
    heavy = [s for f, s in size.items() if "/day=7/" in f]
    assert 16 <= len(heavy) <= 21 and max(heavy) < 0.08 * sum(size.values())
    assert len({f.rsplit("part-", 1)[1][:5] for f in size if "/day=7/" not in f}) <= 5  # small days share tasks
    back = spark.read.parquet(path)
    assert back.count() == 50_000 and back.where("day = 7").count() == df.where("day = 7").count()


def test_files_and_buckets_come_from_bytes(spark, sf_small):
    from cumulus.operators.joins import input_bytes
    li, o = tb.table(spark, sf_small, "lineitem"), tb.table(spark, sf_small, "orders")
    size = input_bytes(li)
    assert input_bytes(li.join(o, li.l_orderkey == o.o_orderkey)) == size + input_bytes(o)
    assert input_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), 'k long')) is None
    assert sinks.file_count(li, size) == 1 and sinks.file_count(li, size // 10) in (10, 11)
    assert sinks.bucket_count(o, li, bucket_bytes=size // 10, least=1) == 16
    assert sinks.bucket_count(o, li) == 4
    sinks.write_bucketed(o, "cumulus_bytes_test", "o_orderkey", sinks.bucket_count(o, li, bucket_bytes=size // 10))
    try:
        told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED cumulus_bytes_test").collect()}
        assert told["Num Buckets"] == "16"
    finally:
        sinks.drop_table(spark, "cumulus_bytes_test")


def test_numbering_equals_row_number(spark):
    from cumulus.operators.joins import numbered
    df = spark.range(1000).selectExpr("(id * 7919) % 1009 AS k")
    got = numbered(df, ["k"])
    assert [r.k for r in got.orderBy("pos").collect()] == sorted(r.k for r in df.collect())
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_device_rollup_reuses_cached_aggregate(spark, sf_small):
    agg = lay.events_aggregated(si.device_events(spark, sf_small)).persist()
    try:
        per_user, per_device = lay.user_device_rollup(agg, si.page_devices(spark, sf_small))
        assert "InMemoryRelation" in lay.plan_text(per_user, "extended")
        assert per_user.count() > 0 and per_device.count() > 0
    finally:
        agg.unpersist()


def test_kafka_json_parsing_and_builders(spark):
    payload = ('{"url": "/a", "referrer": "https://www.google.com", "user_agent": "x", '
               '"host": "h", "ip": "10.0.0.1", "headers": "{}", "event_time": "2024-01-01T10:00:00.123Z"}')
    df = spark.createDataFrame([(bytearray(payload, "utf-8"),)], "value binary")
    r = st.parse_json_events(df).collect()[0]
    assert r.host == "h" and r.event_timestamp == dt.datetime(2024, 1, 1, 10, 0, 0, 123000)
    reader = st.kafka_reader(spark, "broker:9092", "events", options={"kafka.security.protocol": "SASL_SSL"})
    assert reader is not None
    writer = sinks.jdbc_batch_writer("jdbc:postgresql://db/x", "t", "u", "p")
    assert callable(writer)


def test_file_stats_counts_files(spark, sf_small):
    r = tb.file_stats(tb.table(spark, sf_small, "orders")).collect()[0]
    assert r.n_files == 1 and r.total_bytes > 0


def test_a_writing_task_holds_a_bounded_share_of_the_input(spark, sf_small, monkeypatch):
    o = tb.table(spark, sf_small, "orders")
    for size in (120 << 20, 1200 << 20, 12000 << 20):  # more input makes more tasks, not larger ones
        monkeypatch.setattr(sinks, "input_bytes", lambda df: size)
        for n in (sinks.file_count(o), sinks.bucket_count(o)):
            assert n * (16 << 20) >= size and n <= 2 * size / (16 << 20)


def test_a_layout_without_placement_moves_no_row(spark):
    path = scratch_path(spark, "unplaced")
    sinks.write_layout(spark.range(0, 1000, 1, 4), path, sort_within=[])
    files = spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    rows = [r.id for r in files.orderBy("f", "i").collect()]
    assert rows == list(range(1000))


def test_unsorted_rows_equal_a_walk_through_the_files(spark, monkeypatch):
    import math
    import random
    rnd = random.Random(5)
    odd = [None, float("nan"), -0.0, 0.0, 1.5, float("inf"), float("-inf")]
    rows = [(rnd.choice([None, 1, 2]), rnd.choice(odd), rnd.choice([None, "", "a", "z", "\u00e9", "\U0001f600", "\uff5e"]),
             rnd.choice([None, True, False])) for _ in range(3000)]
    path = scratch_path(spark, "walk")
    spark.createDataFrame(rows, "a int, x double, s string, b boolean").repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    at = table.select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()

    def rank(v):
        if v is None:
            return (0,)
        if isinstance(v, float):
            return (1, 1, 0) if math.isnan(v) else (1, 0, v)
        return (1, v.encode() if isinstance(v, str) else v)

    for order in (["a"], ["x"], ["s"], ["b"], ["a", "x", "s", "b"], ["b", "s", "x"]):
        want = sum(p.f == q.f and [rank(p[c]) for c in order] > [rank(q[c]) for c in order] for p, q in zip(at, at[1:]))
        out = lay.unsorted_rows(table, order)
        assert out.first().unsorted_rows == want > 0
        plan = lay.plan_text(out, "simple")  # the rows are compared before they are moved
        assert plan.index("Exchange hashpartitioning(f") < plan.index("MapInArrow")
        with monkeypatch.context() as mp:  # types without an Arrow order take the window
            mp.setattr(lay, "_ordered", lambda *_: None)
            assert lay.unsorted_rows(table, order).first().unsorted_rows == want
