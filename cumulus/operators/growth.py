"""Growth accounting (A18), retention (A19) and lifecycle state tracking
(A20).

Incremental forms merge yesterday's table with today's activity by one
full outer join, CASE branches in the reference's order. Backfill forms
build the same table for every period in one pass: active periods are
pre-aggregated per (key, period) (distinct, map-side combined), grouped
once per key, and the per-key spine is generated from that one row by
expanding each active period up to the next one: no window at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.operators.cumulative import active_days

NEW, RETAINED, RESURRECTED, CHURNED, STALE = "New", "Retained", "Resurrected", "Churned", "Stale"
# Lifecycle labels of the player state table.
L_NEW, L_RETIRED, L_CONTINUED, L_RETURNED, L_STAYED = (
    "New", "Retired", "Continued Playing", "Returned from Retirement", "Stayed Retired")


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def activity_spine(active: DataFrame, keys, period: str, end, with_list: bool = False,
                   step: Column | None = None) -> DataFrame:
    """Per key, one row per period from its first active period to ``end``.

    ``active``: distinct (keys, period) rows. Output: keys, ``period``,
    ``first_active``, ``is_active``, ``last_before`` (last active period
    strictly before), and optionally ``history`` (active periods <= this
    one, ascending).

    Linear in the output: each active period d_i is expanded forward to
    the period before d_{i+1} (or ``end``); on those rows the last active
    period is d_i itself (d_{i-1} on d_i's own row). No window, no per-key
    sort, no membership test per row.
    """
    ks = _keys(keys)
    per_key = active.groupBy(*ks).agg(F.sort_array(F.collect_list(period)).alias("_all"))
    per_key = per_key.select(*ks, F.filter("_all", lambda x: x <= end).alias("_hist"))
    per_key = per_key.filter(F.size("_hist") > 0)
    runs = per_key.select(*ks, "_hist", F.element_at("_hist", 1).alias("first_active"),
                          F.posexplode("_hist").alias("_i", "_d"))
    nxt = F.get("_hist", F.col("_i") + 1)   # get is 0-based and null out of range
    prv = F.get("_hist", F.col("_i") - 1)
    if step is None:
        stop = F.least(F.coalesce(nxt - 1, end), end)
        seq = F.sequence(F.col("_d"), stop)
    else:
        stop = F.least(F.coalesce(F.date_sub(nxt, 1), end), end)
        seq = F.sequence(F.col("_d"), stop, step)
    spine = runs.select(*ks, "first_active", "_hist", "_i", "_d", prv.alias("_prev"),
                        F.explode(seq).alias(period))
    spine = spine.select(*ks, period, "first_active", "_hist", "_i",
                         (F.col(period) == F.col("_d")).alias("is_active"),
                         F.when(F.col(period) == F.col("_d"), F.col("_prev"))
                          .otherwise(F.col("_d")).alias("last_before"))
    cols = [*ks, period, "first_active", "is_active", "last_before"]
    if with_list:
        spine = spine.withColumn("history", F.slice("_hist", 1, F.col("_i") + 1))
        cols.append("history")
    return spine.select(*cols)


# --------------------------------------------------------------------------
# A18 growth accounting
# --------------------------------------------------------------------------
def _daily_state(y_exists, t_active, y_last, y_date, today) -> Column:
    return (F.when(~y_exists, NEW)
            .when(t_active & (y_last == F.date_sub(today, 1)), RETAINED)
            .when(t_active & (y_last < F.date_sub(today, 1)), RESURRECTED)
            .when(~t_active & (y_last == y_date), CHURNED)
            .otherwise(STALE))


def _weekly_state(y_exists, t_active, y_last, y_date, today) -> Column:
    last = F.when(t_active, today).otherwise(y_last)
    return (F.when(~y_exists, NEW)
            .when(t_active & (y_last < F.date_sub(today, 7)), RESURRECTED)
            .when(~t_active & (y_last == F.date_sub(y_date, 7)), CHURNED)
            .when(F.date_add(last, 7) >= y_date, RETAINED)
            .otherwise(STALE))


def growth_accounting(prev: DataFrame, events: DataFrame, keys, today: str,
                      date_col: str = "event_date") -> DataFrame:
    """A18 incremental: yesterday's growth table + today's activity.
    The date list is appended at the end (oldest first)."""
    ks = _keys(keys)
    d = F.to_date(F.lit(today))
    t = active_days(events, ks, date_col, start=today, end=today).withColumn("_t", F.lit(True))
    y = (prev.filter(F.col("date") == F.date_sub(d, 1))
         .select(*ks, F.col("first_active_date").alias("_y_first"),
                 F.col("last_active_date").alias("_y_last"),
                 F.col("dates_active").alias("_y_list"), F.col("date").alias("_y_date"),
                 F.lit(True).alias("_y")))
    j = t.join(y, ks, "full_outer")
    y_exists = F.coalesce(F.col("_y"), F.lit(False))
    t_active = F.coalesce(F.col("_t"), F.lit(False))
    return j.select(
        *ks,
        F.coalesce("_y_first", "date_active").alias("first_active_date"),
        F.coalesce("date_active", "_y_last").alias("last_active_date"),
        _daily_state(y_exists, t_active, F.col("_y_last"), F.col("_y_date"), d).alias("daily_active_state"),
        _weekly_state(y_exists, t_active, F.col("_y_last"), F.col("_y_date"), d).alias("weekly_active_state"),
        F.concat(F.coalesce("_y_list", F.array().cast("array<date>")),
                 F.when(t_active, F.array(d)).otherwise(F.array().cast("array<date>"))).alias("dates_active"),
        F.coalesce(F.col("date_active"), F.date_add("_y_date", 1)).alias("date"))


def growth_backfill(events: DataFrame, keys, start: str, end: str,
                    date_col: str = "event_date", with_lists: bool = True) -> DataFrame:
    """A18 for every day from ``start`` to ``end`` in one pass; equal to
    running the incremental form daily."""
    ks = _keys(keys)
    active = active_days(events, ks, date_col, start=start, end=end).withColumnRenamed("date_active", "date")
    s = activity_spine(active, ks, "date", F.to_date(F.lit(end)), with_list=with_lists,
                       step=F.expr("INTERVAL 1 DAY"))
    d = F.col("date")
    y_exists = d > F.col("first_active")
    t_active = F.col("is_active")
    y_last, y_date = F.col("last_before"), F.date_sub(d, 1)
    cols = [*ks,
            F.col("first_active").alias("first_active_date"),
            F.when(t_active, d).otherwise(y_last).alias("last_active_date"),
            _daily_state(y_exists, t_active, y_last, y_date, d).alias("daily_active_state"),
            _weekly_state(y_exists, t_active, y_last, y_date, d).alias("weekly_active_state")]
    if with_lists:
        cols.append(F.col("history").alias("dates_active"))
    cols.append(d)
    return s.select(*cols)


def retention(growth: DataFrame) -> DataFrame:
    """By days since first activity, share of rows whose daily state
    is active (Retained, Resurrected, New) and the row count."""
    g = growth.select(F.datediff("date", "first_active_date").alias("days_since_first_active"),
                      F.col("daily_active_state").isin(RETAINED, RESURRECTED, NEW).alias("_a"))
    return (g.groupBy("days_since_first_active")
            .agg(F.count_if("_a").alias("_n_active"), F.count(F.lit(1)).alias("num_rows"))
            .select("days_since_first_active",
                    (F.col("_n_active").cast("double") / F.col("num_rows")).alias("pct_active"),
                    "num_rows"))


# --------------------------------------------------------------------------
# A20 lifecycle state tracking
# --------------------------------------------------------------------------
def _lifecycle(y_exists, t_active, y_last, y_cur, cur) -> Column:
    # 'Stayed Retired' is tested before 'Retired' so it is reachable.
    return (F.when(~y_exists, L_NEW)
            .when(~t_active & (y_last < y_cur), L_STAYED)
            .when(~t_active, L_RETIRED)
            .when(cur - y_last == 1, L_CONTINUED)
            .otherwise(L_RETURNED))


def state_tracking(prev: DataFrame, today: DataFrame, key: str, period: str,
                   year: int) -> DataFrame:
    """A20 incremental: ``prev`` = table at ``year - 1`` (key,
    current_year, first_active_year, last_active_year, player_state,
    years_active); ``today`` = keys active in ``year`` (column ``period``)."""
    t = (today.filter(F.col(period) == year).select(key).distinct()
         .withColumn("_t", F.lit(True)))
    y = (prev.filter(F.col("current_year") == year - 1)
         .select(key, F.col("first_active_year").alias("_y_first"),
                 F.col("last_active_year").alias("_y_last"),
                 F.col("years_active").alias("_y_list"), F.col("current_year").alias("_y_cur"),
                 F.lit(True).alias("_y")))
    j = t.join(y, key, "full_outer")
    y_exists = F.coalesce(F.col("_y"), F.lit(False))
    t_active = F.coalesce(F.col("_t"), F.lit(False))
    cur = F.lit(year)
    return j.select(
        key, cur.alias("current_year"),
        F.coalesce(F.col("_y_first"), cur).alias("first_active_year"),
        F.when(t_active, cur).otherwise(F.col("_y_last")).alias("last_active_year"),
        _lifecycle(y_exists, t_active, F.col("_y_last"), F.col("_y_cur"), cur).alias("player_state"),
        F.when(~t_active, F.col("_y_list"))
         .when(F.col("_y_list").isNull(), F.array(cur))
         .otherwise(F.concat("_y_list", F.array(cur))).alias("years_active"))


def lifecycle_backfill(active: DataFrame, key: str, period: str, end: int) -> DataFrame:
    """A20 for every year from each key's first to ``end`` in one pass."""
    a = active.select(key, F.col(period).cast("int").alias("current_year")).distinct()
    s = activity_spine(a, key, "current_year", F.lit(end), with_list=True)
    cur = F.col("current_year")
    y_exists = cur > F.col("first_active")
    return s.select(
        key, cur.alias("current_year"),
        F.col("first_active").alias("first_active_year"),
        F.when(F.col("is_active"), cur).otherwise(F.col("last_before")).alias("last_active_year"),
        _lifecycle(y_exists, F.col("is_active"), F.col("last_before"), cur - 1, cur).alias("player_state"),
        F.col("history").alias("years_active"))
