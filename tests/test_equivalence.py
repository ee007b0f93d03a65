"""Equivalence properties: incremental loops equal one-pass backfills;
streaming output equals batch output on the same rows."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulus.operators import cumulative as cum
from cumulus.operators import growth as gr
from cumulus.operators import scd
from cumulus.plans import standins as si
from cumulus.plans.periods import run_periods
from cumulus.streaming import streams as st

STATS = ["gp", "pts", "reb", "ast"]
STATIC = ["c_mktsegment", "c_nationkey"]


def test_snapshot_loop_equals_backfill(spark, sf_small):
    detail = si.customer_years(spark, sf_small).cache()
    empty = cum.backfill_snapshot(detail.limit(0), "c_custkey", "season", STATS, STATIC, end=1994)

    def step(prev, year):
        return cum.cumulate_snapshot(prev, detail.filter(F.col("season") == year), "c_custkey",
                                     "season", STATS, STATIC)
    last, paths = run_periods(spark, step, range(1995, 2002), initial=empty)
    assert len(paths) == 7
    one_pass = cum.backfill_snapshot(detail, "c_custkey", "season", STATS, STATIC, end=2001)
    assertDataFrameEqual(last.filter("current_season = 2001"),
                         one_pass.filter("current_season = 2001").select(*last.columns))


def test_scd_incremental_equals_backfill(spark, sf_small):
    detail = si.customer_years(spark, sf_small)
    snap = cum.backfill_snapshot(detail, "c_custkey", "season", STATS, STATIC, end=2001).cache()
    tracked = ["scoring_class", "is_active"]
    prev = scd.scd2_backfill(snap, "c_custkey", "current_season", tracked, 2000)
    inc = scd.scd2_incremental(prev, snap, "c_custkey", tracked, 2000, 2001)
    full = scd.scd2_backfill(snap, "c_custkey", "current_season", tracked, 2001)
    assertDataFrameEqual(inc, full.select(*inc.columns))


def test_datelist_and_growth_loops_equal_backfill(spark, sf_small):
    ev = si.events(spark, sf_small).cache()
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(10)]
    empty_dl = spark.createDataFrame([], "user_id long, date date, dates_active array<date>")
    dl, _ = run_periods(spark, lambda prev, d: cum.cumulate_datelist(prev, ev, "user_id", d),
                        days, initial=empty_dl)
    assertDataFrameEqual(dl, cum.datelist_backfill(ev, "user_id", days[-1]).select(*dl.columns))

    keys = ["user_id", "event_type"]
    empty_g = spark.createDataFrame([], "user_id long, event_type string, first_active_date date, "
                                        "last_active_date date, daily_active_state string, "
                                        "weekly_active_state string, dates_active array<date>, date date")
    g, _ = run_periods(spark, lambda prev, d: gr.growth_accounting(prev, ev, keys, d), days,
                       initial=empty_g)
    back = gr.growth_backfill(ev, keys, days[0], days[-1]).filter(F.col("date") == days[-1])
    assertDataFrameEqual(g, back.select(*g.columns))


def test_metric_array_loop_equals_backfill(spark, sf_small):
    ev = si.events(spark, sf_small).cache()
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(6)]
    empty = spark.createDataFrame([], "user_id long, month_start date, metric_name string, "
                                      "metric_array array<long>")
    arr, _ = run_periods(spark, lambda prev, d: cum.cumulate_metric_array(prev, ev, "user_id", d, "hits"),
                         days, initial=empty)
    back = cum.metric_array_backfill(ev, "user_id", days[-1], "hits")
    assertDataFrameEqual(arr, back.select(*arr.columns))


def test_stream_tumbling_equals_batch(spark, sf_small):
    s = st.with_event_time(st.file_events_stream(spark, sf_small), "ts")
    _, base = st.run_to_log(st.tumbling_counts(s, "ts", ["event_type"]), "update")
    streamed = st.read_latest(spark, base, ["window_start", "event_type"])
    batch = st.tumbling_counts(si.events(spark, sf_small), "ts", ["event_type"])
    assertDataFrameEqual(streamed.select(*batch.columns), batch)


def test_epoch_log_compaction(spark, sf_small):
    from cumulus.session import scratch_path
    s = st.with_event_time(st.file_events_stream(spark, sf_small), "ts")
    _, base = st.run_to_log(st.tumbling_counts(s, "ts", ["event_type"]), "update")
    target = st.compact_log(spark, base, ["window_start", "event_type"], scratch_path(spark, "compacted"))
    assertDataFrameEqual(st.read_latest(spark, target, ["window_start", "event_type"]),
                         st.read_latest(spark, base, ["window_start", "event_type"]))


def test_two_outputs_from_one_source(spark, sf_small):
    src = st.file_events_stream(spark, sf_small)
    by_type, by_user = st.two_outputs(src, "ts", ["event_type"], ["user_id"])
    _, a = st.run_to_log(by_type, "update")
    _, b = st.run_to_log(by_user, "update")
    ev = si.events(spark, sf_small)
    assertDataFrameEqual(st.read_latest(spark, a, ["window_start", "event_type"]).select(
        "window_start", "event_type", "num_hits"), st.tumbling_counts(ev, "ts", ["event_type"]))
    assertDataFrameEqual(st.read_latest(spark, b, ["window_start", "user_id"]).select(
        "window_start", "user_id", "num_hits"), st.tumbling_counts(ev, "ts", ["user_id"]))


def test_split_sessions_equal_session_window(spark):
    import random
    from cumulus.operators.sessions import sessionize_split
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for key, n, spread in (("hot", 3000, 40), ("warm", 300, 400), ("cold", 20, 4000)):
        t = base
        for _ in range(n):
            # steps of 0..spread seconds, with exact 300 s gaps mixed in
            step = 300 if rnd.random() < 0.05 else rnd.randint(0, spread)
            t = t + dt.timedelta(seconds=step)
            rows.append((key, t))
    df = spark.createDataFrame(rows, "host string, ts timestamp")
    split = sessionize_split(df, "ts", ["host"], 300, bucket_seconds=600)
    native = st.sessionize(df, "ts", ["host"], "5 minutes")
    assertDataFrameEqual(split, native.select(*split.columns))


def test_actor_items_loop_equals_backfill(spark, sf_small):
    films = si.actor_films(spark, sf_small).cache()
    cols = ["filmid", "film", "votes", "rating"]
    score = F.col("rating_cents")
    bands = [(8 * 5_000_000, "star"), (7 * 5_000_000, "good"), (6 * 5_000_000, "average")]
    empty = spark.createDataFrame([], "actorid long, films array<struct<filmid:bigint,film:string,"
                                      "votes:int,rating:double>>, quality_class string, "
                                      "is_active boolean, current_year int")
    last, _ = run_periods(spark, lambda prev, y: cum.cumulate_items(prev, films, "actorid", "year", cols,
                                                                     score, y, bands=bands),
                          range(1995, 2002), initial=empty)
    back = cum.backfill_items(films, "actorid", "year", cols, score, 2001, bands=bands)
    assertDataFrameEqual(last, back.filter("current_year = 2001").select(*last.columns))
