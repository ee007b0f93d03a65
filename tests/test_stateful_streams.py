"""Open sessions, late events and several outputs of one streaming query,
across restarts and replays."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulus.operators.sessions import sessionize_split
from cumulus.session import scratch_path
from cumulus.streaming import sessions as sess
from cumulus.streaming import streams as st

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
KEYS = ["event_type", "user_id"]


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def put(spark, folder, events, n):
    rows = [(i, at(s), u, k, 1.0, "{}") for i, (s, u, k) in enumerate(events)]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def source(spark, folder):
    return st.file_events_stream(spark, folder).select(*KEYS, "ts")


@pytest.fixture
def stream(spark):
    """A folder of events, and a run of the session query over what is new."""
    folder, base, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))

    def run(events):
        put(spark, folder, events, 1)
        plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
        spark.conf.set(sess.PROVIDER, plain)  # a session that isn't set up for it
        sess.run_sessions(sess.session_updates(source(spark, folder), "ts", KEYS, 300), base, ckpt)
        assert spark.conf.get(sess.PROVIDER) == plain
        spark.conf.set(sess.PROVIDER, sess.ROCKSDB)
        got = sess.latest_sessions(spark, base, KEYS).collect()
        late = sess.late_events(spark, base, KEYS).collect()
        seconds = lambda t: int((t - dt.datetime(2024, 1, 1)).total_seconds())
        return (sorted((r.event_type, r.user_id, seconds(r.session_start), seconds(r.session_end), r.num_hits, r.status)
                       for r in got), sorted((r.event_type, r.user_id, seconds(r.event_time)) for r in late))
    return run


def test_sessions_are_opened_revised_joined_and_closed_over_restarts(stream):
    got, late = stream([(0, 1, "a"), (10, 1, "a"), (0, 2, "b")])
    assert got == [("a", 1, 0, 310, 2, "open"), ("b", 2, 0, 300, 1, "open")] and late == []
    # a gap of exactly 300 s merges; an earlier event moves a session's start
    got, late = stream([(310, 1, "a"), (250, 3, "c"), (200, 3, "c")])
    assert got == [("a", 1, 0, 610, 3, "open"), ("b", 2, 0, 300, 1, "open"), ("c", 3, 200, 550, 2, "open")]
    # the watermark (985 s) passes a, b and c; d stays open
    got, late = stream([(1000, 4, "d")])
    closed = [("a", 1, 0, 610, 3, "closed"), ("b", 2, 0, 300, 1, "closed"), ("c", 3, 200, 550, 2, "closed")]
    assert got == [*closed, ("d", 4, 1000, 1300, 1, "open")] and late == []
    # too late for any session; not too late, as its session would still be open; a bridge between two sessions
    got, late = stream([(600, 1, "a"), (700, 1, "a"), (1450, 5, "e"), (1760, 5, "e")])
    assert late == [("a", 1, 600)]
    assert ("a", 1, 700, 1000, 1, "closed") in got and ("e", 5, 1450, 1750, 1, "open") in got
    got, late = stream([(1600, 5, "e")])
    assert ("e", 5, 1450, 2060, 3, "open") in got and not any(r[:3] == ("e", 5, 1760) for r in got)
    assert sum(r[4] for r in got) + len(late) == 12  # every event is in a session or late


def test_random_batches_equal_the_batch_form(spark, stream):
    import random
    r = random.Random(5)
    events = sorted(((r.randrange(20000), r.randrange(4), r.choice("xy")) for _ in range(300)))
    got = late = None
    for i in range(0, 300, 100):  # in order of time, so nothing is late
        part = events[i:i + 100]
        r.shuffle(part)
        got, late = stream(part)
    assert late == []
    df = spark.createDataFrame([(at(s), u, k) for s, u, k in events], "ts timestamp, user_id bigint, event_type string")
    want = sessionize_split(df, "ts", KEYS, 300).collect()
    seconds = lambda t: int((t - dt.datetime(2024, 1, 1)).total_seconds())
    assert [g[:5] for g in got] == sorted((w.event_type, w.user_id, seconds(w.session_start), seconds(w.session_end), w.num_hits)
                                          for w in want)
    mark = max(s for s, *_ in events) - 15
    assert all((g[5] == "closed") == (g[3] <= mark) for g in got)


def test_two_outputs_share_a_query_an_epoch_and_a_replay(spark):
    folder, base, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    outputs = {"by_type": st.window_deltas("ts", ["event_type"]), "by_user": st.window_deltas("ts", KEYS)}
    ids = set()
    for batch in ([(0, 1, "a"), (1, 2, "a")], [(2, 1, "a"), (400, 1, "b")]):
        put(spark, folder, batch, 1)
        q, _ = st.run_fanout(source(spark, folder), outputs, base, ckpt)
        ids.add(q.id)
    assert len(ids) == 1

    def read():
        return (sorted(map(tuple, st.summed_deltas(st.read_committed(spark, base, "by_type"), ["event_type"])
                           .select("event_type", "num_hits", F.unix_timestamp("window_start") % 86400).collect())),
                sorted(map(tuple, st.summed_deltas(st.read_committed(spark, base, "by_user"), KEYS)
                           .select("event_type", "user_id", "num_hits").collect())))

    before = read()
    assert before == ([("a", 3, 0), ("b", 1, 300)], [("a", 1, 2), ("a", 2, 1), ("b", 1, 1)])
    again = spark.createDataFrame([(at(2), 1, "a"), (at(400), 1, "b")], "ts timestamp, user_id bigint, event_type string")
    st.epoch_fanout(base, outputs)(again, 1)  # the second epoch is replayed after a failure
    assert read() == before
    again.withColumn("num_hits", F.lit(9)).withColumn("window_start", F.col("ts")).write.parquet(f"{base}/by_type/epoch=2")
    assert read() == before  # an epoch that isn't committed is not seen


def test_fanout_reads_a_batch_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("timestamp_seconds(id) AS ts", "id % 3 AS user_id")
    batch = df.mapInArrow(counted, df.schema)
    st.epoch_fanout(scratch_path(spark, "once"), {
        "a": st.window_deltas("ts", []), "b": st.window_deltas("ts", ["user_id"])})(batch, 0)
    assert seen.value == 100
