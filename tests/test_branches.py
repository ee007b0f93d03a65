"""Branches no driver table reaches (unit rows)."""
import datetime as dt
import os

from pyspark.sql import Row, functions as F

from cumulus.functions.columns import safe_ratio
from cumulus.operators import cumulative as cum
from cumulus.operators import enrich as en
from cumulus.operators import growth as gr
from cumulus.operators import layout as lay
from cumulus.operators import patterns as pt
from cumulus.operators import scd
from cumulus.session import scratch_path
from cumulus.streaming import streams as st

D = dt.date
T = dt.datetime


def _detail(spark, rows):
    return spark.createDataFrame(rows, "name string, season int, pts double")


def test_snapshot_key_only_prev_both_and_new(spark):
    d = _detail(spark, [("a", 2000, 25.0), ("b", 2000, 5.0), ("b", 2001, 16.0), ("c", 2001, 11.0)])
    prev = cum.backfill_snapshot(d, "name", "season", ["pts"], end=2000)
    out = cum.cumulate_snapshot(prev, d.filter("season = 2001"), "name", "season", ["pts"])
    got = {r["name"]: r for r in out.collect()}
    assert got["a"]["scoring_class"] == "star" and got["a"]["years_since_last_season"] == 1
    assert got["a"]["current_season"] == 2001 and got["a"]["is_active"] is False
    assert [s["season"] for s in got["b"]["season_stats"]] == [2000, 2001]
    assert got["b"]["scoring_class"] == "good" and got["b"]["years_since_last_season"] == 0
    assert got["c"]["scoring_class"] == "average" and len(got["c"]["season_stats"]) == 1


def test_first_element_zero(spark):
    d = _detail(spark, [("a", 2000, 0.0), ("a", 2001, 12.0), ("b", 2000, 10.0), ("b", 2001, 15.0)])
    snap = cum.backfill_snapshot(d, "name", "season", ["pts"], end=2001)
    got = {r["name"]: r["performance_score"] for r in cum.first_last_change(snap, "name", 2001).collect()}
    assert got == {"a": 12.0, "b": 0.5}


def test_scd_incremental_nulls_missing_key_and_changes(spark):
    scd_rows = spark.createDataFrame(
        [("a", "good", 1998, 1999), ("a", "bad", 2000, 2000), ("b", None, 1999, 2000),
         ("c", "star", 2000, 2000), ("d", "good", 2000, 2000)],
        "k string, cls string, start_season int, end_season int")
    today = spark.createDataFrame(
        [("a", "bad", 2001), ("b", "good", 2001), ("c", None, 2001), ("e", "bad", 2001)],
        "k string, cls string, current_season int")
    out = scd.scd2_incremental(scd_rows, today, "k", ["cls"], 2000, 2001)
    got = [(r["k"], r["cls"], r["start_season"], r["end_season"]) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == set([
        ("a", "good", 1998, 1999), ("a", "bad", 2000, 2001),      # history kept, unchanged extended
        ("b", None, 1999, 2000), ("b", "good", 2001, 2001),       # null -> value is a change
        ("c", "star", 2000, 2000), ("c", None, 2001, 2001),       # value -> null is a change
        ("d", "good", 2000, 2000),                                # absent today: kept, closed
        ("e", "bad", 2001, 2001)])                                # new key


def test_metric_array_new_key_padding_and_rerun(spark):
    ev = spark.createDataFrame([(1, D(2024, 1, 3)), (1, D(2024, 1, 3)), (2, D(2024, 1, 3))],
                               "user_id long, event_date date")
    prev = spark.createDataFrame([(1, D(2024, 1, 1), "hits", [1, 0])],
                                 "user_id long, month_start date, metric_name string, metric_array array<long>")
    out = cum.cumulate_metric_array(prev, ev, "user_id", "2024-01-03", "hits")
    got = {r["user_id"]: r["metric_array"] for r in out.collect()}
    assert got == {1: [1, 0, 2], 2: [0, 0, 1]}
    again = cum.cumulate_metric_array(out, ev, "user_id", "2024-01-03", "hits")
    assert {r["user_id"]: r["metric_array"] for r in again.collect()} == got
    empty = spark.createDataFrame([("2024-01-01", [])], "month_start string, metric_array array<long>")
    assert cum.monthly_hits_wide(empty).collect()[0]["num_hits_first_day"] == 0


def test_bits_window_and_top_bit(spark):
    dl = spark.createDataFrame(
        [(1, D(2024, 3, 1), [D(2024, 3, 1), D(2024, 2, 1), D(2024, 1, 1)])],
        "user_id long, date date, dates_active array<date>")
    r = cum.datelist_int(dl, "user_id", "2024-03-01").collect()[0]
    # today is bit 31; 29 days earlier is bit 2; 60 days earlier is ignored
    assert r["datelist_int"] == 2 ** 31 + 2 ** 2
    assert r["datelist_bits"] == "1" + "0" * 28 + "100"
    assert r["dim_is_daily_active"] and r["dim_is_weekly_active"] and r["dim_is_monthly_active"]


def test_every_growth_state(spark):
    prev = spark.createDataFrame([
        ("retained", D(2024, 1, 1), D(2024, 1, 9), D(2024, 1, 9)),
        ("resurrected", D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 9)),
        ("churned", D(2024, 1, 1), D(2024, 1, 9), D(2024, 1, 9)),
        ("stale", D(2024, 1, 1), D(2024, 1, 5), D(2024, 1, 9)),
        ("wk_churned", D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 9)),
    ], "user_id string, first_active_date date, last_active_date date, date date")
    prev = prev.withColumn("dates_active", F.array("last_active_date"))
    ev = spark.createDataFrame([("retained", D(2024, 1, 10)), ("resurrected", D(2024, 1, 10)),
                                ("new", D(2024, 1, 10))], "user_id string, event_date date")
    out = gr.growth_accounting(prev, ev, "user_id", "2024-01-10")
    got = {r["user_id"]: (r["daily_active_state"], r["weekly_active_state"]) for r in out.collect()}
    assert got == {"retained": ("Retained", "Retained"), "resurrected": ("Resurrected", "Resurrected"),
                   "churned": ("Churned", "Retained"), "stale": ("Stale", "Retained"),
                   "wk_churned": ("Stale", "Churned"), "new": ("New", "New")}


def test_lifecycle_retired_twice(spark):
    active = spark.createDataFrame([("a", 1998), ("a", 1999), ("b", 1999), ("c", 1997)],
                                   "k string, season int")
    t = gr.lifecycle_backfill(active, "k", "season", 2001)
    got = {(r["k"], r["current_year"]): r["player_state"] for r in t.collect()}
    assert got[("a", 2000)] == "Retired" and got[("a", 2001)] == "Stayed Retired"
    assert got[("c", 1998)] == "Retired" and got[("c", 1999)] == "Stayed Retired"
    assert got[("b", 1999)] == "New"


def test_funnel_ties_and_target_on_other_day(spark):
    rows = [(1, T(2024, 1, 1, 9), "view"), (1, T(2024, 1, 1, 9), "view"),
            (1, T(2024, 1, 1, 10), "click"), (1, T(2024, 1, 1, 11), "purchase"),
            (2, T(2024, 1, 1, 9), "view"), (2, T(2024, 1, 1, 10), "click"),
            (2, T(2024, 1, 2, 9), "purchase")]
    ev = spark.createDataFrame(rows, "user_id long, ts timestamp, event_type string") \
        .withColumn("event_date", F.to_date("ts"))
    got = {r["event_type"]: (r["num_events"], r["conversion_rate"])
           for r in pt.funnel(ev, "event_type", "purchase", min_count=0).collect()}
    # user 1: the tied views collapse to one row; user 2 buys on another day.
    assert got == {"view": (2, 0.5), "click": (1, 1.0)}


def test_session_gap_exactly_equal_merges(spark):
    rows = [("h", T(2024, 1, 1, 0, 0)), ("h", T(2024, 1, 1, 0, 4)), ("h", T(2024, 1, 1, 0, 9)),
            ("h", T(2024, 1, 1, 0, 20))]
    df = spark.createDataFrame(rows, "host string, ts timestamp")
    got = sorted((r["session_start"], r["session_end"], r["num_hits"])
                 for r in st.sessionize(df, "ts", ["host"]).collect())
    assert got == [(T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 14), 3),
                   (T(2024, 1, 1, 0, 20), T(2024, 1, 1, 0, 25), 1)]


def test_late_event_dropped_by_watermark_across_restart(spark):
    """Two runs over one checkpoint: the second file arrives after the first
    run; its event older than the watermark is dropped, the rest merges
    into the first run's windows (restart from checkpoint)."""
    src = scratch_path(spark, "late-src")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    b1 = [(1, T(2024, 1, 1, 12, 0), 1, "view", 1.0, "{}"), (2, T(2024, 1, 1, 12, 30), 1, "view", 1.0, "{}")]
    b2 = [(3, T(2024, 1, 1, 11, 0), 1, "view", 1.0, "{}"), (4, T(2024, 1, 1, 12, 31), 1, "view", 1.0, "{}")]
    out_base = scratch_path(spark, "late-out")
    ckpt = scratch_path(spark, "late-ckpt")

    def run():
        s = (spark.readStream.schema(st.EVENTS_SCHEMA).option("recursiveFileLookup", "true")
             .parquet(src).withColumn("ts", F.col("ts").cast("timestamp")))
        agg = st.tumbling_counts(st.with_event_time(s, "ts"), "ts", ["event_type"])
        return st.run_to_log(agg, "update", base=out_base, checkpoint=ckpt)[0]

    spark.createDataFrame(b1, schema).coalesce(1).write.parquet(os.path.join(src, "a"))
    run()
    spark.createDataFrame(b2, schema).coalesce(1).write.parquet(os.path.join(src, "b"))
    q = run()
    out = {r["window_start"]: r["num_hits"]
           for r in st.read_latest(spark, out_base, ["window_start", "event_type"]).collect()}
    assert T(2024, 1, 1, 11, 0) not in out          # older than the watermark: dropped
    assert out == {T(2024, 1, 1, 12, 0): 1, T(2024, 1, 1, 12, 30): 2}
    assert st.dropped_by_watermark(q) == 1


def test_unknown_and_malformed_ip(spark):
    geo = spark.createDataFrame([(167772160, 167772170, "X")], "ip_start long, ip_end long, country string")
    df = spark.createDataFrame([("10.0.0.5",), ("10.0.0.200",), ("not-an-ip",), (None,)], "ip string")
    got = {r["ip"]: r["geodata"] for r in en.enrich_geo(df, "ip", geo, ["country"]).collect()}
    assert got == {"10.0.0.5": '{"country":"X"}', "10.0.0.200": "{}", "not-an-ip": "{}", None: "{}"}


def test_zero_denominator_and_tied_top1(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, None]
    t = spark.createDataFrame([("x",), ("y",), ("y",), ("x",)], "k string")
    assert lay.top1(t, "k").collect() == [Row(k="x", num=2)]


def test_rolling_share_row_and_calendar_frames(spark):
    days = [D(2024, 1, d) for d in (1, 2, 3, 10, 11)]
    rows = [("ref.example", "/a", d) for d in days for _ in range(2)]
    df = spark.createDataFrame(rows, "referrer string, url string, event_date date")
    by_rows = {r.event_date: r.weekly_rolling_count
               for r in pt.rolling_share(df, min_total=0).collect()}
    by_days = {r.event_date: r.weekly_rolling_count
               for r in pt.rolling_share(df, min_total=0, frame="range", prev_block=(-13, -7)).collect()}
    assert by_rows[D(2024, 1, 10)] == 8          # 4 rows back: 1, 2, 3, 10
    assert by_days[D(2024, 1, 10)] == 2          # calendar week 4..10 holds only day 10
    assert by_days[D(2024, 1, 11)] == 4


def test_stream_reads_a_folder_of_part_files(spark, sf_small, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    from cumulus.plans.catalog import QUERIES
    spark.read.parquet(f"{sf_small}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    name = "tumbling_counts"
    assert QUERIES[name](spark, str(tmp_path)).count() == QUERIES[name](spark, sf_small).count() > 0
    with pytest.raises(AnalysisException):
        QUERIES[name](spark, str(tmp_path / "none"))


def test_wide_month_of_more_than_seven_days(spark):
    from cumulus.operators.cumulative import monthly_hits_wide
    a = spark.createDataFrame([("2024-01-01", list(range(1, 10))), ("2024-01-01", [1])], "month_start string, metric_array array<bigint>")
    r = monthly_hits_wide(a, days=9).first().asDict()
    assert (r["num_hits_first_day"], r["num_hits_seventh_day"], r["num_hits_day_8"], r["num_hits_day_9"]) == (2, 7, 8, 9)
