"""Batch and streaming jobs: read tables, apply one operator, write one
partition. Each periodic job reads only the previous period's partition
of its own table (partition pruning) and replaces only the new period's
partition (dynamic partition overwrite), so a re-run of a day is
idempotent and lineage never spans more than one period.

CLI: ``python -m cumulus.plans.jobs <job> --events ... --table ... --day ...``
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from cumulus.operators import cumulative as cum
from cumulus.operators import graph as gp
from cumulus.operators import growth as gr
from cumulus.operators import scd
from cumulus.sources.tables import events_utc
from cumulus.sources.versions import VersionedTable
from cumulus.streaming import streams as st


def _day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def read_partition(spark: SparkSession, path: str, col: str, value, schema: str) -> DataFrame:
    """One partition of a partitioned parquet table; empty (with the
    table's schema) only on a first run: when the table does not exist, or
    holds no period up to ``value``. A table with earlier periods but not
    this one has a gap, which stops the job, as any other error does."""
    found = existing(spark, path)
    if found is None:
        return spark.createDataFrame([], schema)
    here = found.filter(F.col(col) == F.lit(value))
    if here.isEmpty():
        newest = found.filter(F.col(col) < F.lit(value)).agg(F.max(col)).first()[0]
        if newest is not None:
            raise ValueError(f"{path} has no {col} = {value}; its newest earlier period is {newest}: "
                             "run the missing periods first")
    return here


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_partition(df: DataFrame, path: str, col: str) -> None:
    """Replace only the partitions present in ``df`` (K2)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).parquet(path))


def _events_on(spark: SparkSession, events_path: str, day: str) -> DataFrame:
    d = _day(day)
    e = spark.read.parquet(events_path)
    e = e.filter((F.col("ts") >= F.lit(dt.datetime.combine(d, dt.time()))) &
                 (F.col("ts") < F.lit(dt.datetime.combine(d + dt.timedelta(days=1), dt.time()))))
    return events_utc(e)


# ---------------------------------------------------------------- daily jobs
def datelist_job(spark: SparkSession, events_path: str, table_path: str, day: str,
                 keys: Sequence[str] = ("user_id",)) -> None:
    """A12 daily: user (or host, or composite-key) date list."""
    ks = list(keys)
    key_schema = ", ".join(f"{k} {'string' if k == 'host' else 'bigint'}" for k in ks)
    prev = read_partition(spark, table_path, "date", _day(day) - dt.timedelta(days=1),
                          f"{key_schema}, dates_active array<date>, date date")
    ev = _events_on(spark, events_path, day)
    if "host" in ks:
        ev = ev.withColumnRenamed("event_type", "host")
    write_partition(cum.cumulate_datelist(prev, ev, ks, day), table_path, "date")


def growth_job(spark: SparkSession, events_path: str, table_path: str, day: str,
               keys: Sequence[str] = ("user_id",)) -> None:
    """A18 daily: growth accounting states."""
    ks = list(keys)
    key_schema = ", ".join(f"{k} {'string' if k == 'event_type' else 'bigint'}" for k in ks)
    prev = read_partition(spark, table_path, "date", _day(day) - dt.timedelta(days=1),
                          f"{key_schema}, first_active_date date, last_active_date date, "
                          "daily_active_state string, weekly_active_state string, "
                          "dates_active array<date>, date date")
    write_partition(gr.growth_accounting(prev, _events_on(spark, events_path, day), ks, day),
                    table_path, "date")


METRIC_SCHEMA = "user_id bigint, metric_name string, metric_array array<bigint>, month_start date"


def metric_table(spark: SparkSession, table_path: str) -> VersionedTable:
    """The monthly arrays: a versioned table, one folder a month."""
    return VersionedTable(spark, table_path, METRIC_SCHEMA, "month_start")


def metric_array_job(spark: SparkSession, events_path: str, table_path: str, day: str,
                     metric: str = "site_hits", first_day: str | None = None) -> None:
    """A15 daily: the month's arrays with today's slot written, as an upsert
    on (user, month, metric) that becomes a new version, so the version that
    was read stays whole. The last day written is kept with the version: a
    day may be run again, one that would leave a gap stops the job.
    ``first_day`` is the first one of a new table or month (default: the day
    itself, earlier ones of the month counting as zeros)."""
    month, table = _day(day).replace(day=1), metric_table(spark, table_path)
    read = table.version()
    note = f"last:{metric}:{month}"
    last = read.notes.get(note) or (str(_day(first_day) - dt.timedelta(days=1)) if first_day else None)
    if last is not None and _day(day) > _day(last) + dt.timedelta(days=1):
        raise ValueError(f"{table_path}: {metric} was written up to {last}; run the days up to {day} first")
    held = table.read(read, [str(month)])
    prev = held.where(F.col("metric_name") == metric)
    out = cum.cumulate_metric_array(prev, _events_on(spark, events_path, day), "user_id", day, metric)
    columns = [f.split()[0] for f in METRIC_SCHEMA.split(", ")]
    table.upsert(out.select(*columns), ["user_id", "metric_name", "month_start"], read,
                 {note: max(day, last) if last else day})


# ---------------------------------------------------------------- yearly / one-shot jobs
def snapshot_job(spark: SparkSession, detail_path: str, table_path: str, year: int,
                 key: str, period: str, stats: Sequence[str], attrs: Sequence[str] = ()) -> None:
    """A1 yearly: previous snapshot partition + this year's detail rows."""
    detail = spark.read.parquet(detail_path)
    none = cum.backfill_snapshot(detail.limit(0), key, period, stats, attrs, end=year - 1)
    prev = none if existing(spark, table_path) is None else read_partition(
        spark, table_path, cum.CURRENT, year - 1, none.schema)
    out = cum.cumulate_snapshot(prev, detail.filter(F.col(period) == year), key, period, stats, attrs)
    write_partition(out, table_path, cum.CURRENT)


def scd_job(spark: SparkSession, snapshot_path: str, table_path: str, as_of: int, key: str,
            tracked: Sequence[str]) -> None:
    """A5: SCD2 intervals of the snapshot table as of ``as_of``."""
    out = scd.scd2_backfill(spark.read.parquet(snapshot_path), key, cum.CURRENT, tracked, as_of)
    write_partition(out, table_path, "current_season")


def team_vertex_job(spark: SparkSession, teams_path: str, out_path: str) -> None:
    """A7 map form over a teams table."""
    t = spark.read.parquet(teams_path)
    props = {c: F.col(c) for c in t.columns if c != "team_id"}
    gp.dedup_vertices(t, "team_id", "team", props, as_map=True).write.mode("overwrite").parquet(out_path)


def monthly_site_hits_job(spark: SparkSession, arrays_path: str, out_path: str, ds: str) -> None:
    """A16 wide form over one date partition."""
    a = spark.read.parquet(arrays_path)
    cum.monthly_hits_wide(a, "date_partition", ds).write.mode("overwrite").parquet(out_path)


# ---------------------------------------------------------------- streaming job
def web_stream_job(spark: SparkSession, source_dir: str, out_base: str, checkpoint: str,
                   keys: Sequence[str] = ("event_type",), trigger_seconds: int = 10,
                   wait: bool = False):
    """A25 continuous: watermarked 5-minute counts, micro-batch every
    ``trigger_seconds`` (offsets and state in ``checkpoint``)."""
    s = st.with_event_time(st.file_events_stream(spark, source_dir), "ts")
    q, _ = st.run_to_log(st.tumbling_counts(s, "ts", list(keys)), "update", out_base, checkpoint,
                         trigger={"processingTime": f"{trigger_seconds} seconds"}, wait=wait)
    return q


def main(argv: Sequence[str] | None = None) -> None:
    from cumulus.session import get_session
    p = argparse.ArgumentParser(prog="cumulus.plans.jobs")
    p.add_argument("job", choices=["datelist", "growth", "metric-array"])
    p.add_argument("--events", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--day", required=True)
    p.add_argument("--keys", default="user_id")
    a = p.parse_args(argv)
    spark = get_session(app=f"cumulus-{a.job}")
    keys = a.keys.split(",")
    if a.job == "datelist":
        datelist_job(spark, a.events, a.table, a.day, keys)
    elif a.job == "growth":
        growth_job(spark, a.events, a.table, a.day, keys)
    else:
        metric_array_job(spark, a.events, a.table, a.day)


if __name__ == "__main__":
    main()
