"""Analytical patterns: funnel (A17), grouping-set dashboards (A21),
rolling shares (A22), streaks (A23) and best rolling stretch (A24).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.functions.columns import classify_like, referrer_rules, safe_ratio
from cumulus.operators.joins import positions, task_count


# --------------------------------------------------------------------------
# A17 funnel
# --------------------------------------------------------------------------
def funnel(events: DataFrame, step: str, target: str, user: str = "user_id",
           time: str = "ts", day: str = "event_date", min_count: int = 100,
           extra_dedup: Sequence[str] = ()) -> DataFrame:
    """Per step: events that have a later same-day event of the same user,
    and the share of those whose user later (same day) reaches ``target``.
    Kept when the share is > 0 and the count > ``min_count``.

    The reference's self join (quadratic per user-day) becomes: one
    aggregate per (user, day) - last event time and last target time,
    partial/final so a hot user-day is combined map-side - joined back to
    the distinct events. The aggregate grows with the data, so no hint:
    AQE broadcasts it at run time when its measured size is small, and
    otherwise keeps the shuffle join and splits a skewed (user, day).
    Events that share user, time and step collapse to one row, as in the
    reference's grouping.
    """
    e = (events.filter(F.col(user).isNotNull())
         .select(user, time, step, day, *extra_dedup).distinct()
         .select(user, time, step, day).distinct())
    per_day = e.groupBy(user, day).agg(
        F.max(time).alias("_last"),
        F.max(F.when(F.col(step) == target, F.col(time))).alias("_last_target"))
    j = e.join(per_day, [user, day], "inner")
    later = j.filter(F.col(time) < F.col("_last"))
    conv = (F.coalesce(F.col(time) < F.col("_last_target"), F.lit(False))).cast("int")
    out = (later.groupBy(step)
           .agg(F.count(F.lit(1)).alias("num_events"), F.sum(conv).alias("_conv"))
           .select(step, "num_events", safe_ratio("_conv", "num_events").alias("conversion_rate")))
    return out.filter((F.col("conversion_rate") > 0) & (F.col("num_events") > min_count))


# --------------------------------------------------------------------------
# A21 grouping sets
# --------------------------------------------------------------------------
def grouping_sets_dashboard(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
                            labels: Sequence[str], measures: Sequence[Column],
                            overall: str | None = "(overall)") -> DataFrame:
    """Counts at several grains in one aggregation (one shuffle, Expand
    before the partial aggregate). ``labels[i]`` names ``sets[i]``; the
    level is identified by ``grouping()`` of each dimension, never by a
    null key. Rolled-up keys show ``overall`` when given."""
    dims = list(dims)
    g = df.groupingSets([list(s) for s in sets], *dims).agg(
        *measures, *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    level = None
    for s, label in zip(sets, labels):
        cond = None
        for d in dims:
            c = (F.col(f"_g_{d}") == (0 if d in s else 1))
            cond = c if cond is None else (cond & c)
        level = F.when(cond, label) if level is None else level.when(cond, label)
    keys = [F.coalesce(F.col(d).cast("string"), F.lit(overall)).alias(d) if overall is not None
            else F.col(d) for d in dims]
    meas = [c for c in g.columns if c not in dims and not c.startswith("_g_")]
    return g.select(level.alias("aggregation_level"), *keys, *meas)


# --------------------------------------------------------------------------
# A22 rolling shares
# --------------------------------------------------------------------------
def rolling_share(df: DataFrame, referrer: str = "referrer", url: str = "url",
                  day: str = "event_date", rules=None, site_domains: Sequence[str] = (),
                  min_total: int = 500,
                  prev_block: tuple[int, int] = (-13, -6), frame: str = "rows") -> DataFrame:
    """Channel classification, daily counts, month and grand totals,
    7-row rolling count and the previous block, share of month and
    of total. ``frame="rows"`` counts rows (days with events), as in the
    reference, and the previous block default keeps its one-row overlap;
    ``frame="range"`` counts calendar days instead (a day without events
    still takes its place in the 7-day window).

    Counts are aggregated first (partial/final), so each window partition
    holds one (referrer, url)'s days, not its events.
    """
    rules = rules if rules is not None else referrer_rules(site_domains)
    e = df.select(classify_like(referrer, rules).alias("referrer"), F.col(url).alias("url"),
                  F.col(day).alias("event_date"))
    daily = e.groupBy("referrer", "url", "event_date").agg(F.count(F.lit(1)).alias("count"))
    series = Window.partitionBy("referrer", "url")
    by_day = series.orderBy("event_date" if frame == "rows" else F.unix_date("event_date"))
    between = by_day.rowsBetween if frame == "rows" else by_day.rangeBetween

    def hits(frame_of) -> Column:
        return F.sum("count").over(frame_of)

    def share(frame_of) -> Column:
        return F.col("count").cast("double") / hits(frame_of)

    month = Window.partitionBy("referrer", "url", F.trunc("event_date", "month"))
    shares = daily.select("*", hits(series).alias("_all"),
                          hits(between(-6, 0)).alias("weekly_rolling_count"),
                          hits(between(*prev_block)).alias("previous_weekly_rolling_count"),
                          share(month).alias("pct_of_month"), share(series).alias("pct_of_total"))
    return shares.where((F.col("_all") > min_total) & F.col("referrer").isNotNull()).drop("_all")


# --------------------------------------------------------------------------
# A23 longest streak, A24 best rolling stretch
# --------------------------------------------------------------------------
def longest_streak(df: DataFrame, key: str, order: Sequence[str], chunk: Sequence[Column],
                   predicate: Column) -> DataFrame:
    """Longest run of consecutive rows (by ``order``) where ``predicate``
    holds (null counts as false), per key. Keys without a qualifying row
    are absent.

    ``chunk`` lists nested chunks that coarsen the order (e.g. day, then id
    bucket in the day), so a hot key is spread over many window partitions.
    Rows are sorted and windowed once, inside their chunk; one aggregate
    gives each chunk's row count, best run, leading and trailing run. These
    summaries are stitched level by level (the buckets of a day, then the
    days of a key), so no window holds more rows than one level has parts.
    Most chunks may hold a row or two, so an aggregate of them is as large as
    its rows: each level is dealt over tasks whose number grows with the input,
    and what one of them holds doesn't.
    """
    names = [f"_c{i}" for i in range(len(chunk))]
    tasks = task_count(df)
    d = df.select(key, *order, *[c.alias(n) for c, n in zip(chunk, names)],
                  F.coalesce(predicate, F.lit(False)).alias("_ok")).repartition(tasks, key, *names)
    w = Window.partitionBy(key, *names).orderBy(*order)
    failed = F.when(~F.col("_ok"), F.col("_r"))
    rows = d.withColumn("_r", F.row_number().over(w))
    rows = rows.withColumn("_stop", F.coalesce(F.max(failed).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))
    n = F.count(F.lit(1))
    parts = rows.groupBy(key, *names).agg(
        n.alias("_n"), F.max(F.col("_r") - F.col("_stop")).alias("_best"),
        F.coalesce(F.min(failed) - 1, n).alias("_head"),
        (n - F.coalesce(F.max(failed), F.lit(0))).alias("_tail"))
    broken = F.col("_head") < F.col("_n")
    first_failed = F.when(broken, F.col("_off") + F.col("_head"))
    last_failed = F.when(broken, F.col("_off") + F.col("_n") - F.col("_tail"))
    for k in reversed(range(len(names))):
        group = [key, *names[:k]]
        before = Window.partitionBy(*group).orderBy(names[k]).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.repartition(tasks, *group)
        parts = parts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        parts = parts.withColumn("_stop", F.coalesce(F.max(last_failed).over(before), F.lit(0)))
        n = F.sum("_n")
        parts = parts.groupBy(*group).agg(
            F.max(F.greatest(F.col("_best"), F.col("_off") - F.col("_stop") + F.col("_head"))).alias("_best"),
            F.coalesce(F.min(first_failed), n).alias("_head"),
            (n - F.coalesce(F.max(last_failed), F.lit(0))).alias("_tail"), n.alias("_n"))
    return parts.where("_best > 0").select(key, F.col("_best").alias("longest_streak"))


def best_rolling_wins(df: DataFrame, key: str, order: Sequence[str], chunk: Sequence[Column],
                      win: Column, n: int = 90) -> DataFrame:
    """Most wins in any ``n`` consecutive rows per key (full stretches only).

    With W(i) the running win count at position i, a stretch ending at i
    has W(i) - W(i - n) wins. Rows get their positions in one pass; each then
    sends W to its own position and, as the value before the stretch, to the
    position n further on, where one aggregate on (key, position) brings the
    two together. Both columns are hashed, so a hot key is spread.
    """
    p = positions(df.withColumn("_win", win.cast("long")), [key], order, chunk,
                  sums={"_w": F.col("_win")}).select(key, "pos", "_w")
    none = F.lit(None).cast("long")
    sent = F.explode(F.array(F.struct(F.col("pos"), F.col("_w").alias("_end"), none.alias("_before")),
                             F.struct((F.col("pos") + n).alias("pos"), none.alias("_end"), F.col("_w").alias("_before"))))
    at = p.select(key, sent.alias("s")).groupBy(key, F.col("s.pos").alias("pos")).agg(
        F.max("s._end").alias("_end"), F.max("s._before").alias("_before"))
    full = at.where((F.col("pos") >= n) & F.col("_end").isNotNull())
    return full.groupBy(key).agg(F.max(F.col("_end") - F.coalesce("_before", F.lit(0))).alias(f"max_wins_{n}"))
