"""Periodic jobs over partitioned tables: daily runs equal the one-pass
backfill; re-running a day is idempotent."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulus.operators import cumulative as cum
from cumulus.operators import growth as gr
from cumulus.plans import jobs
from cumulus.plans import standins as si
from cumulus.session import scratch_path

DAYS = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(5)]


def test_daily_jobs_equal_backfill_and_rerun_is_idempotent(spark, sf_small):
    ev_path = f"{sf_small}/events.parquet"
    dl, gt, ma = (scratch_path(spark, n) for n in ("dl", "growth", "arrays"))
    for d in DAYS + [DAYS[-1]]:          # the last day twice
        jobs.datelist_job(spark, ev_path, dl, d)
        jobs.growth_job(spark, ev_path, gt, d)
        jobs.metric_array_job(spark, ev_path, ma, d)
    ev = si.events(spark, sf_small)
    got = spark.read.parquet(dl).filter(F.col("date") == DAYS[-1])
    assertDataFrameEqual(got.select("user_id", "date", "dates_active"),
                         cum.datelist_backfill(ev, "user_id", DAYS[-1]).select("user_id", "date", "dates_active"))
    g = spark.read.parquet(gt).filter(F.col("date") == DAYS[-1])
    back = gr.growth_backfill(ev, ["user_id"], DAYS[0], DAYS[-1]).filter(F.col("date") == DAYS[-1])
    assertDataFrameEqual(g.select(*back.columns), back)
    arr = jobs.metric_table(spark, ma).read()
    assert arr.count() == arr.select("user_id").distinct().count()
    assertDataFrameEqual(arr.select("user_id", "metric_array"),
                         cum.metric_array_backfill(ev, "user_id", DAYS[-1], "site_hits")
                         .select("user_id", "metric_array"))


def test_yearly_snapshot_and_scd_jobs(spark, sf_small):
    detail_path = scratch_path(spark, "detail")
    si.customer_years(spark, sf_small).write.parquet(detail_path)
    snap_path, scd_path = scratch_path(spark, "snap"), scratch_path(spark, "scd")
    stats = ["gp", "pts", "reb", "ast"]
    for y in range(1995, 2002):
        jobs.snapshot_job(spark, detail_path, snap_path, y, "c_custkey", "season", stats,
                          ["c_mktsegment", "c_nationkey"])
    got = spark.read.parquet(snap_path).filter("current_season = 2001")
    want = cum.backfill_snapshot(spark.read.parquet(detail_path), "c_custkey", "season", stats,
                                 ["c_mktsegment", "c_nationkey"], end=2001).filter("current_season = 2001")
    assertDataFrameEqual(got.select(*want.columns), want)
    jobs.scd_job(spark, snap_path, scd_path, 2001, "c_custkey", ["scoring_class", "is_active"])
    assert spark.read.parquet(scd_path).filter("current_season = 2001").count() > 0


def test_team_vertex_and_monthly_hits_jobs(spark, sf_small):
    teams = scratch_path(spark, "teams")
    tb = spark.createDataFrame([(1, "A", "x"), (1, "A", "y"), (2, "B", "z")],
                               "team_id long, abbreviation string, city string")
    tb.write.parquet(teams)
    out = scratch_path(spark, "team_v")
    jobs.team_vertex_job(spark, teams, out)
    assert spark.read.parquet(out).count() == 2
    arrays = scratch_path(spark, "arrays_in")
    spark.createDataFrame([("2023-01-01", [1, 2, 3], "2023-01-03"), ("2023-01-01", [], "2023-01-03"),
                           ("2023-01-01", [5, 5, 5], "2023-01-04")],
                          "month_start string, metric_array array<bigint>, date_partition string").write.parquet(arrays)
    hits = scratch_path(spark, "hits")
    jobs.monthly_site_hits_job(spark, arrays, hits, "2023-01-03")
    r = spark.read.parquet(hits).collect()
    assert [(x.num_hits_first_day, x.num_hits_second_day, x.num_hits_third_day) for x in r] == [(1, 2, 3)]


def test_web_stream_job_runs_on_a_trigger(spark, sf_small):
    from cumulus.streaming import streams as st
    out, ckpt = scratch_path(spark, "web_out"), scratch_path(spark, "web_ckpt")
    q = jobs.web_stream_job(spark, sf_small, out, ckpt, trigger_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = st.read_latest(spark, out, ["window_start", "event_type"])
    want = st.tumbling_counts(si.events(spark, sf_small), "ts", ["event_type"])
    assertDataFrameEqual(got.select(*want.columns), want)


def test_gap_and_wrong_column_stop_a_job(spark, tmp_path):
    from pyspark.errors import AnalysisException
    import pytest
    from cumulus.plans.jobs import read_partition, write_partition
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    schema = "user_id bigint, date date"
    assert read_partition(spark, path, "date", day(9), schema).isEmpty()
    write_partition(spark.createDataFrame([(1, day(10))], schema), path, "date")
    assert read_partition(spark, path, "date", day(9), schema).isEmpty()  # first period run again
    assert read_partition(spark, path, "date", day(10), schema).count() == 1
    with pytest.raises(ValueError):
        read_partition(spark, path, "date", day(12), schema)
    with pytest.raises(AnalysisException):
        read_partition(spark, path, "dat", day(10), schema).count()
