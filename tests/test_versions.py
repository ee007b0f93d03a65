"""The versioned table: upserts, crashes between write and commit, races,
old versions for running readers."""
import datetime as dt

import pytest

from cumulus.plans import jobs
from cumulus.session import scratch_path
from cumulus.sources.versions import CommitConflict, VersionedTable

SCHEMA = "k bigint, part string, v bigint"


def rows(df):
    return sorted(map(tuple, df.select("k", "part", "v").collect()))


def table(spark, part="part"):
    return VersionedTable(spark, scratch_path(spark, "versions"), SCHEMA, part)


@pytest.mark.parametrize("part", [None, "part"])
def test_upsert_replaces_rows_and_keeps_old_versions(spark, part):
    t = table(spark, part)
    make = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    assert rows(t.read()) == [] and t.version().number == 0
    t.upsert(make((1, "a", 1), (2, "b/ c", 2)), ["k", "part"])
    before = t.version()
    t.upsert(make((1, "a", 9), (3, "a", 3)), ["k", "part"], notes={"day": "x"})
    assert rows(t.read()) == [(1, "a", 9), (2, "b/ c", 2), (3, "a", 3)]
    assert rows(t.read(before)) == [(1, "a", 1), (2, "b/ c", 2)]
    assert rows(t.read(t.version(1))) == rows(t.read(before)) and t.version().notes == {"day": "x"}
    if part:
        assert t.version().folders["b/ c"] == before.folders["b/ c"]  # untouched partitions aren't written again
        assert rows(t.read(parts=["a"])) == [(1, "a", 9), (3, "a", 3)]
    # new rows may come from the version that they replace
    old = t.read()
    t.upsert(old.withColumn("v", old.v + 1), ["k", "part"])
    assert rows(t.read()) == [(1, "a", 10), (2, "b/ c", 3), (3, "a", 4)]


def test_rows_without_a_partition_value_are_replaced_too(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "a", 3)], SCHEMA), ["k", "part"])
    t.upsert(spark.createDataFrame([(2, "", 5)], SCHEMA), ["k", "part"])
    assert sorted(map(str, t.read().select("k", "part", "v").collect())) == sorted(
        map(str, spark.createDataFrame([(1, None, 1), (2, "", 5), (3, "a", 3)], SCHEMA).collect()))


def test_a_crash_between_write_and_commit_leaves_the_old_version(spark, monkeypatch):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k", "part"])
    with monkeypatch.context() as m:
        m.setattr(t, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost the driver")))
        with pytest.raises(OSError):
            t.upsert(spark.createDataFrame([(1, "a", 2)], SCHEMA), ["k", "part"])
    assert t.numbers() == [1] and rows(t.read()) == [(1, "a", 1)]
    t.upsert(spark.createDataFrame([(1, "a", 3)], SCHEMA), ["k", "part"])
    assert rows(t.read()) == [(1, "a", 3)]


def test_of_two_writers_one_is_told(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k", "part"])
    read = t.version()
    t.upsert(spark.createDataFrame([(2, "a", 2)], SCHEMA), ["k", "part"], read)
    with pytest.raises(CommitConflict):
        t.upsert(spark.createDataFrame([(3, "a", 3)], SCHEMA), ["k", "part"], read)
    assert rows(t.read()) == [(1, "a", 1), (2, "a", 2)]
    with pytest.raises(ValueError):
        t.version(7)


def test_the_rename_itself_refuses_a_taken_number(spark, monkeypatch):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k", "part"])
    monkeypatch.setattr(t, "numbers", lambda: [])  # the other writer's commit wasn't seen yet
    with pytest.raises(CommitConflict):
        t.upsert(spark.createDataFrame([(1, "a", 2)], SCHEMA), ["k", "part"])
    monkeypatch.undo()
    assert rows(t.read()) == [(1, "a", 1)]


def test_vacuum_keeps_what_the_newest_versions_name(spark):
    t = table(spark)
    for v in range(4):
        t.upsert(spark.createDataFrame([(1, "a", v), (2, "b", 0)] if v == 0 else [(1, "a", v)], SCHEMA), ["k", "part"])
    old = t.version(3)
    assert t.vacuum(keep=2) and t.numbers() == [3, 4]
    assert rows(t.read()) == [(1, "a", 3), (2, "b", 0)] and rows(t.read(old)) == [(1, "a", 2), (2, "b", 0)]
    assert t.vacuum(keep=2) == []


def test_metric_arrays_refuse_a_gap_and_repeat_a_day(spark, sf_small):
    ev, base = f"{sf_small}/events.parquet", scratch_path(spark, "arrays")
    day = lambda n: str(dt.date(2024, 1, n))
    for n in (1, 2, 2):
        jobs.metric_array_job(spark, ev, base, day(n))
    before = jobs.metric_table(spark, base).version()
    with pytest.raises(ValueError, match="2024-01-02"):
        jobs.metric_array_job(spark, ev, base, day(4))
    assert jobs.metric_table(spark, base).version() == before
    jobs.metric_array_job(spark, ev, base, day(3))
    assert jobs.metric_table(spark, base).read().selectExpr("max(size(metric_array))").first()[0] == 3
    with pytest.raises(ValueError):  # a month's first days can't be left out either
        jobs.metric_array_job(spark, ev, scratch_path(spark, "arrays"), day(5), first_day=day(1))
