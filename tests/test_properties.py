"""Property tests: chunked positions equal a whole-key row_number; split
sessions equal session windows, for random data and random chunk sizes."""
import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st_
from pyspark.sql import Window, functions as F

from cumulus.operators.joins import positions
from cumulus.operators.sessions import sessionize_split
from cumulus.streaming import streams as st

rows_strategy = st_.lists(st_.tuples(st_.integers(0, 3), st_.integers(0, 400), st_.booleans()),
                          min_size=1, max_size=120, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, bucket=st_.sampled_from([1, 7, 50, 1000]))
def test_positions_equal_row_number(spark, rows, bucket):
    df = spark.createDataFrame(rows, "k int, i int, ok boolean")
    got = positions(df, ["k"], ["i"], [F.floor(F.col("i") / bucket)], sums={"q": F.col("ok").cast("long")})
    w = Window.partitionBy("k").orderBy("i")
    ref = df.select("k", "i", "ok", F.row_number().over(w).alias("pos"),
                    F.sum(F.col("ok").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("q"))
    assert sorted(got.collect()) == sorted(ref.select(*got.columns).collect())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st_.lists(st_.tuples(st_.integers(0, 1), st_.integers(0, 900)), min_size=1, max_size=80),
       bucket=st_.sampled_from([60, 300, 3600]))
def test_split_sessions_equal_session_window(spark, steps, bucket):
    base = dt.datetime(2024, 1, 1)
    t = {0: base, 1: base}
    rows = []
    for key, step in steps:
        t[key] = t[key] + dt.timedelta(seconds=step)
        rows.append((f"h{key}", t[key]))
    df = spark.createDataFrame(rows, "host string, ts timestamp")
    a = sessionize_split(df, "ts", ["host"], 300, bucket_seconds=bucket)
    b = st.sessionize(df, "ts", ["host"], "5 minutes").select(*a.columns)
    assert sorted(a.collect()) == sorted(b.collect())


def _model_growth(active_days, start, end):
    """Day-by-day model of the incremental rules (yesterday's row + today)."""
    out, y = {}, None
    d = start
    while d <= end:
        t = d in active_days
        if y is None and not t:
            d += dt.timedelta(days=1)
            continue
        if y is None:
            daily = weekly = "New"
            first, last = d, d
        else:
            first, y_last, y_date = y["first"], y["last"], d - dt.timedelta(days=1)
            if t and y_last == d - dt.timedelta(days=1):
                daily = "Retained"
            elif t and y_last < d - dt.timedelta(days=1):
                daily = "Resurrected"
            elif not t and y_last == y_date:
                daily = "Churned"
            else:
                daily = "Stale"
            last_or = d if t else y_last
            if t and y_last < d - dt.timedelta(days=7):
                weekly = "Resurrected"
            elif not t and y_last == y_date - dt.timedelta(days=7):
                weekly = "Churned"
            elif last_or + dt.timedelta(days=7) >= y_date:
                weekly = "Retained"
            else:
                weekly = "Stale"
            last = d if t else y_last
        y = {"first": first, "last": last}
        out[d] = (first, last, daily, weekly)
        d += dt.timedelta(days=1)
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(acts=st_.lists(st_.sets(st_.integers(0, 24), max_size=10), min_size=1, max_size=4))
def test_growth_backfill_matches_daily_model(spark, acts):
    from cumulus.operators import growth as gr
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 25)
    rows = [(k, start + dt.timedelta(days=o)) for k, offs in enumerate(acts) for o in offs]
    if not rows:
        return
    ev = spark.createDataFrame(rows, "user_id long, event_date date")
    got = {(r.user_id, r.date): (r.first_active_date, r.last_active_date, r.daily_active_state,
                                 r.weekly_active_state)
           for r in gr.growth_backfill(ev, ["user_id"], str(start), str(end), with_lists=False).collect()}
    want = {}
    for k, offs in enumerate(acts):
        days = {start + dt.timedelta(days=o) for o in offs}
        for d, v in _model_growth(days, start, end).items():
            want[(k, d)] = v
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, bucket=st_.sampled_from([1, 5, 40, 1000]))
def test_longest_streak_equals_islands(spark, rows, bucket):
    from cumulus.operators import patterns as pt
    df = spark.createDataFrame(rows, "k int, i int, ok boolean")
    got = {r.k: r.longest_streak for r in
           pt.longest_streak(df, "k", ["i"], [F.floor(F.col("i") / bucket)], F.col("ok")).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        run = best = 0
        for _, _, ok in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            run = run + 1 if ok else 0
            best = max(best, run)
        if best:
            want[k] = best
    assert got == want
