"""The reference's own unit tests, re-expressed on new rows."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulus.operators import cumulative as cum
from cumulus.operators import graph as gp
from cumulus.operators import scd

D = dt.date


def test_monthly_hits_sum_empty_array_and_partition_filter(spark):
    rows = [("2023-03-01", [1, 2, 3], "2023-03-31"),
            ("2023-03-01", [4, 5, 6], "2023-03-31"),
            ("2023-04-01", [], "2023-03-31"),
            ("2023-05-01", [9, 9, 9], "2023-05-31")]
    df = spark.createDataFrame(rows, "month_start string, metric_array array<long>, date_partition string")
    out = cum.monthly_hits_wide(df, "date_partition", "2023-03-31")
    expected = spark.createDataFrame(
        [("2023-03-01", 5, 7, 9), ("2023-04-01", 0, 0, 0)],
        "month_start string, num_hits_first_day long, num_hits_second_day long, num_hits_third_day long")
    assertDataFrameEqual(out, expected)


def test_player_scd_streaks(spark):
    rows = [("Michael Jordan", 2001, "good"), ("Michael Jordan", 2002, "good"),
            ("Michael Jordan", 2003, "bad"), ("Someone Else", 2003, "bad")]
    df = spark.createDataFrame(rows, "player_name string, current_season long, scoring_class string")
    out = scd.scd2_backfill(df, "player_name", "current_season", ["scoring_class"], 2003,
                            start_col="start_date", end_col="end_date").drop("current_season")
    expected = spark.createDataFrame(
        [("Michael Jordan", "good", 2001, 2002), ("Michael Jordan", "bad", 2003, 2003),
         ("Someone Else", "bad", 2003, 2003)],
        "player_name string, scoring_class string, start_date int, end_date int")
    assertDataFrameEqual(out, expected)


def test_team_vertex_duplicate_collapses(spark):
    rows = [(1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
            (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900)]
    df = spark.createDataFrame(rows, "team_id long, abbreviation string, nickname string, city string, "
                                     "arena string, yearfounded long")
    out = gp.dedup_vertices(df, "team_id", "team", {
        "abbreviation": F.col("abbreviation"), "nickname": F.col("nickname"),
        "city": F.col("city"), "arena": F.col("arena"),
        "year_founded": F.col("yearfounded")}, as_map=True)
    got = out.collect()
    assert len(got) == 1
    assert got[0]["identifier"] == 1 and got[0]["type"] == "team"
    # the row kept is the first by the other columns (deterministic)
    assert got[0]["properties"]["nickname"] == "Bad Warriors"
    assert got[0]["properties"]["year_founded"] == "1900"


def _events(spark, rows, key):
    df = spark.createDataFrame(rows, f"{key} long, event_time string")
    return df.withColumn("event_date", F.to_date(F.col("event_time").cast("timestamp")))


def test_host_cumulated_no_previous_and_duplicates(spark):
    ev = _events(spark, [(1, "2023-01-01 10:00:00"), (1, "2023-01-01 11:00:00"),
                         (2, "2023-01-01 12:00:00"), (3, "2023-01-02 00:00:00")], "host")
    prev = spark.createDataFrame([], "host long, date date, dates_active array<date>")
    out = cum.cumulate_datelist(prev, ev, "host", "2023-01-01")
    expected = spark.createDataFrame(
        [(1, D(2023, 1, 1), [D(2023, 1, 1)]), (2, D(2023, 1, 1), [D(2023, 1, 1)])],
        "host long, date date, dates_active array<date>")
    assertDataFrameEqual(out, expected)


def test_user_cumulated_with_previous(spark):
    ev = _events(spark, [(1, "2023-01-02 10:00:00"), (1, "2023-01-02 10:00:00"),
                         (3, "2023-01-02 09:00:00")], "user_id")
    prev = spark.createDataFrame(
        [(1, D(2023, 1, 1), [D(2023, 1, 1)]), (2, D(2023, 1, 1), [D(2022, 12, 31)])],
        "user_id long, date date, dates_active array<date>")
    out = cum.cumulate_datelist(prev, ev, "user_id", "2023-01-02")
    expected = spark.createDataFrame(
        [(1, D(2023, 1, 2), [D(2023, 1, 2), D(2023, 1, 1)]),
         (2, D(2023, 1, 2), [D(2022, 12, 31)]),
         (3, D(2023, 1, 2), [D(2023, 1, 2)])],
        "user_id long, date date, dates_active array<date>")
    assertDataFrameEqual(out, expected)
