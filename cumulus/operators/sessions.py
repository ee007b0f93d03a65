"""Batch sessionization that splits hot keys (A26 batch form).

``session_window`` merges all partial sessions of one key in one task, so
a (host, ip) holding a third of all events would land on one executor.
Here a key's events are cut into time buckets:

1. events are shuffled once by (key, bucket) and ordered by time; a session
   starts where the gap to the previous event of the bucket exceeds ``gap``,
   and one aggregate in place gives the bucket's sessions;
2. only a bucket's first and last session can go on in another bucket. These
   are shuffled by key, two rows a bucket at most, and those at most ``gap``
   apart are joined; every other session is final and goes to a group of its
   own, so a hot key's sessions stay spread.

Two shuffles, and no join back to the events.

Semantics equal ``session_window``: a gap of exactly ``gap`` merges;
start = first event, end = last event + gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def sessionize_split(df: DataFrame, time_col: str, keys: Sequence[str], gap_seconds: int,
                     bucket_seconds: int = 3600) -> DataFrame:
    ks = list(keys)
    gap_us = int(gap_seconds) * 1_000_000
    bucket_us = int(bucket_seconds) * 1_000_000
    e = df.select(*ks, F.unix_micros(F.col(time_col)).alias("_us"))
    e = e.withColumn("_b", F.floor(F.col("_us") / bucket_us))

    def runs(rows: DataFrame, within: list, start: str, last: str) -> DataFrame:
        """``rows`` with ``_s``, the start of the run that each belongs to."""
        w = Window.partitionBy(*within).orderBy(start)
        before = F.lag(last).over(w)
        begins = F.when(before.isNull() | (F.col(start) - before > gap_us), F.col(start))
        return rows.withColumn("_begins", begins).withColumn("_s", F.max("_begins").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    parts = runs(e, [*ks, "_b"], "_us", "_us").groupBy(*ks, "_b", "_s").agg(
        F.max("_us").alias("_last"), F.count(F.lit(1)).alias("_n"))
    bucket = Window.partitionBy(*ks, "_b")
    inner = (F.col("_s") > F.min("_s").over(bucket)) & (F.col("_s") < F.max("_s").over(bucket))
    parts = parts.select(*ks, F.col("_s").alias("_start"), "_last", "_n", F.when(inner, F.col("_s")).alias("_final"))
    sess = runs(parts, [*ks, "_final"], "_start", "_last").groupBy(*ks, "_final", "_s").agg(
        F.max("_last").alias("_last"), F.sum("_n").alias("num_hits"))
    return sess.select(F.timestamp_micros("_s").alias("session_start"),
                       F.timestamp_micros(F.col("_last") + gap_us).alias("session_end"),
                       *ks, "num_hits")
