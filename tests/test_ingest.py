"""CSV ingest: rescued lines, contract reasons, one pass, pruned reads."""
import os

from pyspark.sql import types as T

from cumulus.operators import layout as lay
from cumulus.session import scratch_path
from cumulus.sources import ingest

CONTRACT = ingest.Contract(
    T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("v", T.DoubleType()),
                  T.StructField("note", T.StringType())]),
    required=("id", "day"), rules={"positive": "v > 0"})
LINES = ["id,day,v,note", "1,2024-01-02,1.5,fine", '2,2024-01-03,2,"a ""quoted"", note"', "x,2024-01-02,1,bad id",
         "4,,3,no day", "5,2024-01-02,-1,negative", "6,2024-01-02,7,ok,one field more", "7,2024-13-40,,both", "8,2024-01-02",
         ",,,"]


def put(spark, lines):
    path = scratch_path(spark, "csv").replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_good_and_bad_rows_in_one_table(spark):
    t = ingest.ingest_csv(spark, put(spark, LINES), CONTRACT, scratch_path(spark, "out"))
    good = sorted(map(tuple, ingest.accepted(t).selectExpr("id", "string(day)", "v", "note").collect()))
    assert good == [(1, "2024-01-02", 1.5, "fine"), (2, "2024-01-03", 2.0, 'a "quoted", note')]
    bad = {r.rescued or f"{r.id},{r.day},{r.v}": r.reasons for r in t.where("NOT accepted").collect()}
    assert bad == {
        "x,2024-01-02,1,bad id": "missing:id,malformed", "4,None,3.0": "missing:day", "5,2024-01-02,-1.0": "rule:positive",
        "6,2024-01-02,7,ok,one field more": "malformed", "7,2024-13-40,,both": "missing:day,rule:positive,malformed",
        "8,2024-01-02": "rule:positive,malformed", "None,None,None": "missing:id,missing:day,rule:positive"}
    counts = {r.reason: r.n_rows for r in ingest.reason_counts(t).collect()}
    assert counts == {"accepted": 2, "missing:id": 2, "missing:day": 3, "rule:positive": 4, "malformed": 4}


def test_a_job_that_wants_good_rows_reads_only_their_files(spark):
    t = ingest.ingest_csv(spark, put(spark, LINES), CONTRACT, scratch_path(spark, "out"))
    plan = lay.plan_text(ingest.accepted(t).select("id"))
    assert "PartitionFilters: [isnotnull(accepted" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_empty_files(spark):
    t = ingest.ingest_csv(spark, put(spark, LINES[:1]), CONTRACT, scratch_path(spark, "out"))
    assert t.count() == 0 and ingest.reason_counts(t).count() == 0
