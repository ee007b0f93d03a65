"""Cumulative snapshot tables (A1-A4), date lists (A12-A14) and monthly
metric arrays (A15, A16).

Two shapes per table:

* incremental: ``prev`` (last period of the table) full-outer-merged with
  today's rows. One shuffle on the key; used period by period.
* backfill: the same table computed in one pass from the detail. Detail is
  first pre-aggregated per (key, period) - a partial/final hash aggregate,
  so a hot key is combined map-side - then grouped per key once. History
  per key is bounded by the number of periods, never by the raw row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.functions.bits import activity_flags, bits_string, datelist_bits
from cumulus.functions.columns import POINT_BANDS, POINT_BAND_DEFAULT, band

# Output column names of the snapshot table (DDL names).
HISTORY = "season_stats"
BAND = "scoring_class"
GAP = "years_since_last_season"
CURRENT = "current_season"
ACTIVE = "is_active"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# --------------------------------------------------------------------------
# A1 incremental snapshot
# --------------------------------------------------------------------------
def cumulate_snapshot(prev: DataFrame, today: DataFrame, key: str, period: str,
                      stats: Sequence[str], attrs: Sequence[str] = (),
                      metric: str = "pts", bands=POINT_BANDS,
                      default_band: str = POINT_BAND_DEFAULT) -> DataFrame:
    """Merge the last snapshot period with today's detail rows.

    ``prev``: key, attrs, season_stats, scoring_class,
    years_since_last_season, current_season (, is_active).
    ``today``: one row per key with ``period``, attrs and stats columns.
    Attributes: today's value first, else the previous one. History:
    new key -> [row]; seen today -> previous + [row]; absent -> previous.
    """
    t = today.select(key, *[F.col(a).alias(f"_t_{a}") for a in attrs],
                     F.col(period).alias("_t_period"),
                     F.col(metric).alias("_t_metric"),
                     F.struct(*[F.col(c) for c in [period, *stats]]).alias("_t_row"))
    y = prev.select(key, *[F.col(a).alias(f"_y_{a}") for a in attrs],
                    F.col(HISTORY).alias("_y_hist"), F.col(BAND).alias("_y_band"),
                    F.col(GAP).alias("_y_gap"), F.col(CURRENT).alias("_y_cur"))
    j = t.join(y, key, "full_outer")
    seen = F.col("_t_period").isNotNull()
    return j.select(
        key,
        *[F.coalesce(F.col(f"_t_{a}"), F.col(f"_y_{a}")).alias(a) for a in attrs],
        F.when(F.col("_y_hist").isNull(), F.array("_t_row"))
         .when(seen, F.concat("_y_hist", F.array("_t_row")))
         .otherwise(F.col("_y_hist")).alias(HISTORY),
        F.when(seen, band("_t_metric", bands, default_band))
         .otherwise(F.col("_y_band")).alias(BAND),
        F.when(seen, F.lit(0)).otherwise(F.col("_y_gap") + 1).cast("int").alias(GAP),
        F.coalesce(F.col("_t_period"), F.col("_y_cur") + 1).cast("int").alias(CURRENT),
        seen.alias(ACTIVE),
    )


# --------------------------------------------------------------------------
# A2 one-pass backfill
# --------------------------------------------------------------------------
def backfill_snapshot(detail: DataFrame, key: str, period: str, stats: Sequence[str],
                      static: Sequence[str] = (), end: int | None = None,
                      start: int | None = None, metric: str = "pts",
                      bands=POINT_BANDS, default_band: str = POINT_BAND_DEFAULT,
                      end_col: Column | None = None) -> DataFrame:
    """The whole snapshot table, every period from the key's first period
    (or ``start``) to ``end``, in one pass.

    ``detail`` holds one row per (key, period). Static attributes are the
    MAX over the key's rows. The spine is ``sequence(first, end)`` per key
    (no theta join against a period series); history at period p is the
    key's rows with period <= p.
    """
    rows = detail.select(key, period, *static,
                         F.struct(*[F.col(c) for c in [period, *stats]]).alias("_row"))
    per_key = rows.groupBy(key).agg(
        F.min(period).alias("_first"),
        *[F.max(c).alias(c) for c in static],
        F.array_sort(F.collect_list("_row")).alias("_rows"))
    last = F.lit(end) if end_col is None else end_col
    first = F.col("_first") if start is None else F.greatest(F.col("_first"), F.lit(start))
    # sequence(a, b) with a > b counts down: drop keys starting after ``end``.
    spine = (per_key.filter(first <= last)
             .select(key, *static, "_rows", F.explode(F.sequence(first, last)).alias(CURRENT)))
    hist = F.filter("_rows", lambda r: r[period] <= F.col(CURRENT))
    out = spine.select(key, *static, CURRENT, hist.alias(HISTORY))
    last_row = F.element_at(HISTORY, -1)
    return out.select(
        key, *static, HISTORY,
        band(last_row[metric], bands, default_band).alias(BAND),
        (F.col(CURRENT) - last_row[period]).cast("int").alias(GAP),
        F.col(CURRENT).cast("int").alias(CURRENT),
        (last_row[period] == F.col(CURRENT)).alias(ACTIVE),
    ).filter(F.size(HISTORY) > 0)


# --------------------------------------------------------------------------
# A3 / A4 readers of one snapshot period
# --------------------------------------------------------------------------
def unnest_history(snapshot: DataFrame, key: str, as_of: int) -> DataFrame:
    """A3: one row per history element of period ``as_of``."""
    return (snapshot.filter(F.col(CURRENT) == as_of)
            .select(key, F.inline(HISTORY), BAND, GAP, CURRENT))


def first_last_change(snapshot: DataFrame, key: str, as_of: int,
                      metric: str = "pts") -> DataFrame:
    """A4: (last - first) / first of a history metric; when first is 0 the
    last value itself."""
    s = snapshot.filter(F.col(CURRENT) == as_of)
    first = F.element_at(HISTORY, 1)[metric]
    last = F.element_at(HISTORY, -1)[metric]
    return s.select(
        key,
        first.alias(f"first_season_{metric}"),
        last.alias(f"latest_season_{metric}"),
        F.when(first == 0, last).otherwise(F.try_divide(last - first, first))
         .alias("performance_score"))


# --------------------------------------------------------------------------
# A12 date lists
# --------------------------------------------------------------------------
def active_days(events: DataFrame, keys, date_col: str = "event_date",
                start=None, end=None) -> DataFrame:
    """Distinct (keys, day) with non-null keys: a partial/final aggregate,
    so repeated events of one hot key collapse map-side."""
    ks = _keys(keys)
    e = events
    for k in ks:
        e = e.filter(F.col(k).isNotNull())
    if start is not None:
        e = e.filter(F.col(date_col) >= F.to_date(F.lit(start)))
    if end is not None:
        e = e.filter(F.col(date_col) <= F.to_date(F.lit(end)))
    return e.select(*ks, F.col(date_col).alias("date_active")).distinct()


def cumulate_datelist(prev: DataFrame, events: DataFrame, keys, today: str,
                      date_col: str = "event_date",
                      list_col: str = "dates_active") -> DataFrame:
    """today's distinct active keys merged with yesterday's lists;
    today's date is prepended (newest first). ``prev`` is the table's
    previous-day partition: keys, ``date``, ``list_col``."""
    ks = _keys(keys)
    t = active_days(events, ks, date_col, start=today, end=today)
    y = prev.select(*ks, F.col("date").alias("_y_date"), F.col(list_col).alias("_y_list"))
    j = t.join(y, ks, "full_outer")
    return j.select(
        *ks,
        F.coalesce(F.col("date_active"), F.date_add("_y_date", 1)).alias("date"),
        F.when(F.col("_y_list").isNull(), F.array("date_active"))
         .when(F.col("date_active").isNull(), F.col("_y_list"))
         .otherwise(F.concat(F.array("date_active"), F.col("_y_list"))).alias(list_col))


def datelist_backfill(events: DataFrame, keys, as_of: str, start: str | None = None,
                      date_col: str = "event_date",
                      list_col: str = "dates_active") -> DataFrame:
    """The date-list table at ``as_of`` in one pass: equal to running A12
    daily from ``start`` to ``as_of``."""
    ks = _keys(keys)
    days = active_days(events, ks, date_col, start=start, end=as_of)
    return (days.groupBy(*ks)
            .agg(F.sort_array(F.collect_list("date_active"), asc=False).alias(list_col))
            .select(*ks, F.to_date(F.lit(as_of)).alias("date"), list_col))


def datelist_int(datelist: DataFrame, keys, as_of: str, list_col: str = "dates_active",
                 window: int = 32, since: str | None = None) -> DataFrame:
    """A13 + A14: 32-bit activity word, its text, and the three flags."""
    ks = _keys(keys)
    bits = datelist_bits(list_col, as_of, window, since)
    d = datelist.filter(F.col("date") == F.to_date(F.lit(as_of))).select(*ks, bits.alias("datelist_int"))
    return d.select(*ks, "datelist_int", bits_string("datelist_int", window).alias("datelist_bits"),
                    *activity_flags("datelist_int"))


# --------------------------------------------------------------------------
# A15 / A16 monthly metric arrays
# --------------------------------------------------------------------------
def daily_metric(events: DataFrame, keys, day: str | None = None, date_col: str = "event_date",
                 value: Column | None = None, name: str = "metric_value",
                 start: str | None = None, end: str | None = None) -> DataFrame:
    """Per (keys, day) metric: COUNT(1) by default."""
    ks = _keys(keys)
    e = events
    for k in ks:
        e = e.filter(F.col(k).isNotNull())
    if day is not None:
        e = e.filter(F.col(date_col) == F.to_date(F.lit(day)))
    if start is not None:
        e = e.filter(F.col(date_col) >= F.to_date(F.lit(start)))
    if end is not None:
        e = e.filter(F.col(date_col) <= F.to_date(F.lit(end)))
    agg = F.count(F.lit(1)) if value is None else value
    return e.groupBy(*ks, F.col(date_col).alias("date")).agg(agg.cast("long").alias(name))


def cumulate_metric_array(prev: DataFrame, events: DataFrame, keys, day: str,
                          metric_name: str, date_col: str = "event_date",
                          value: Column | None = None) -> DataFrame:
    """Write today's value into slot (day - month_start) of the key's
    month array. New keys are zero-padded; keys without events get 0.
    Placing by index (not appending) makes a re-run of a day overwrite its
    slot instead of appending twice. ``prev``: keys, month_start,
    metric_name, metric_array of the same month."""
    ks = _keys(keys)
    d = F.to_date(F.lit(day))
    month = F.trunc(d, "month")
    idx = F.datediff(d, month)
    today = daily_metric(events, ks, day, date_col, value, "_v")
    y = (prev.filter((F.col("month_start") == month) & (F.col("metric_name") == metric_name))
         .select(*ks, F.col("metric_array").alias("_y_arr")))
    j = today.join(y, ks, "full_outer")
    base = F.coalesce(F.col("_y_arr"), F.array().cast("array<long>"))
    prefix = F.slice(F.concat(base, F.array_repeat(F.lit(0).cast("long"), idx)), 1, idx)
    suffix = F.when(F.size(base) > idx + 1,
                    F.slice(base, idx + 2, F.size(base) - idx - 1)).otherwise(F.array().cast("array<long>"))
    arr = F.concat(prefix, F.array(F.coalesce(F.col("_v"), F.lit(0).cast("long"))), suffix)
    return j.select(*ks, month.alias("month_start"), F.lit(metric_name).alias("metric_name"),
                    arr.alias("metric_array"))


def metric_array_backfill(events: DataFrame, keys, through_day: str, metric_name: str,
                          date_col: str = "event_date", value: Column | None = None) -> DataFrame:
    """The month's array table as of ``through_day`` in one pass: equal to
    running A15 daily from the month start. Every key seen this month gets
    one slot per day up to ``through_day``."""
    ks = _keys(keys)
    d = F.to_date(F.lit(through_day))
    month = F.trunc(d, "month")
    daily = daily_metric(events, ks, None, date_col, value, "_v",
                         start=None, end=through_day).filter(F.col("date") >= month)
    per_key = daily.groupBy(*ks).agg(
        F.map_from_entries(F.collect_list(F.struct(F.datediff("date", month), F.col("_v")))).alias("_m"))
    arr = F.transform(F.sequence(F.lit(0), F.datediff(d, month)),
                      lambda i: F.coalesce(F.element_at("_m", i), F.lit(0).cast("long")))
    return per_key.select(*ks, month.alias("month_start"), F.lit(metric_name).alias("metric_name"),
                          arr.alias("metric_array"))


def metric_array_daily(arrays: DataFrame, group: Sequence[str] = ("metric_name", "month_start")) -> DataFrame:
    """Sum the arrays by index, one row per day:
    month_start + index days. Partial aggregation keeps the shuffle at
    (groups x 31) rows whatever the key count."""
    g = list(group)
    exploded = arrays.select(*g, F.posexplode("metric_array").alias("_pos", "_v"))
    summed = exploded.groupBy(*g, "_pos").agg(F.sum("_v").cast("long").alias("value"))
    return summed.select(*[c for c in g if c != "month_start"],
                         F.date_add("month_start", F.col("_pos")).alias("date"), "value")


def monthly_hits_wide(arrays: DataFrame, partition_col: str | None = None,
                      partition_value: str | None = None, days: int = 3) -> DataFrame:
    """A16 wide form: first ``days`` slots summed per month (named by words up
    to the seventh, by number after it); ``get`` turns an out-of-range slot
    (empty array) into null, coalesced to 0."""
    a = arrays
    if partition_col is not None:
        a = a.filter(F.col(partition_col) == partition_value)
    words = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh"]
    names = [f"num_hits_{w}_day" for w in words] + [f"num_hits_day_{i}" for i in range(len(words) + 1, days + 1)]
    return a.groupBy("month_start").agg(*[
        F.sum(F.coalesce(F.get(F.col("metric_array"), i), F.lit(0))).cast("long")
         .alias(names[i]) for i in range(days)])


# --------------------------------------------------------------------------
# A1 / A2 actor form: several items per key and period, appended flat
# --------------------------------------------------------------------------
def _period_items(items: DataFrame, key: str, period: str, item_cols: Sequence[str],
                  score: Column) -> DataFrame:
    """Per (key, period): the items as a flat array sorted by the first
    item column, and the mean score. Partial/final aggregation per
    (key, period); the array holds one period's items of one key."""
    return items.groupBy(key, period).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in item_cols]))).alias("_items"),
        F.avg(score).alias("_score"))


def cumulate_items(prev: DataFrame, items_today: DataFrame, key: str, period: str,
                   item_cols: Sequence[str], score: Column, year: int,
                   items_col: str = "films", band_col: str = "quality_class",
                   bands=None, default_band: str = POINT_BAND_DEFAULT) -> DataFrame:
    """A1 actor form: previous snapshot (key, items_col, band_col,
    is_active, current_year) + this period's items (several rows per key).
    Items are appended as one flat array; the band is this period's mean
    score banded, else the previous band."""
    from cumulus.functions.columns import RATING_BANDS
    bands = RATING_BANDS if bands is None else bands
    t = _period_items(items_today.filter(F.col(period) == year), key, period, item_cols, score)
    y = prev.filter(F.col("current_year") == year - 1).select(
        key, F.col(items_col).alias("_y_items"), F.col(band_col).alias("_y_band"))
    j = t.join(y, key, "full_outer")
    seen = F.col("_items").isNotNull()
    return j.select(
        key,
        F.when(F.col("_y_items").isNull(), F.col("_items"))
         .when(seen, F.concat("_y_items", "_items"))
         .otherwise(F.col("_y_items")).alias(items_col),
        F.when(seen, band("_score", bands, default_band)).otherwise(F.col("_y_band")).alias(band_col),
        seen.alias(ACTIVE),
        F.lit(year).cast("int").alias("current_year"))


def backfill_items(items: DataFrame, key: str, period: str, item_cols: Sequence[str],
                   score: Column, end: int, items_col: str = "films",
                   band_col: str = "quality_class", bands=None,
                   default_band: str = POINT_BAND_DEFAULT) -> DataFrame:
    """A2 actor form: the whole table from each key's first period to
    ``end`` in one pass (equal to looping :func:`cumulate_items`)."""
    from cumulus.functions.columns import RATING_BANDS
    bands = RATING_BANDS if bands is None else bands
    per = _period_items(items.filter(F.col(period) <= end), key, period, item_cols, score)
    per_key = per.groupBy(key).agg(
        F.min(period).alias("_first"),
        F.array_sort(F.collect_list(F.struct(F.col(period).alias("p"), F.col("_score").alias("s"),
                                             F.col("_items").alias("i")))).alias("_rows"))
    spine = per_key.select(key, "_rows", F.explode(F.sequence(F.col("_first"), F.lit(end))).alias("current_year"))
    upto = F.filter("_rows", lambda r: r["p"] <= F.col("current_year"))
    out = spine.select(key, "current_year", upto.alias("_upto"))
    last = F.element_at("_upto", -1)
    return out.select(
        key,
        F.flatten(F.transform("_upto", lambda r: r["i"])).alias(items_col),
        band(last["s"], bands, default_band).alias(band_col),
        (last["p"] == F.col("current_year")).alias(ACTIVE),
        F.col("current_year").cast("int").alias("current_year"))
