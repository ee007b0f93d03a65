"""Registered queries: each operator of the survey applied to the driver's
tables through the stand-ins. ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Outputs are flat (nested arrays rendered as delimited integer/date text)
so they can be checked against the SQL oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.functions.columns import cents, join_dates, join_ints
from cumulus.operators import cumulative as cum
from cumulus.operators import enrich as en
from cumulus.operators import experiment as ex
from cumulus.operators import facts as fa
from cumulus.operators import graph as gp
from cumulus.operators import growth as gr
from cumulus.operators import layout as lay
from cumulus.operators import patterns as pt
from cumulus.operators import reports as rp
from cumulus.operators import scd
from cumulus.operators.joins import pair_join
from cumulus.operators.sessions import sessionize_split
from cumulus.plans import standins as si
from cumulus.plans.flatten import normalize
from cumulus.session import scratch_path
from cumulus.sources import ingest, sinks
from cumulus.sources.tables import catalog_table, table
from cumulus.sources.versions import VersionedTable
from cumulus.streaming import sessions as sess, streams as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _run(name, fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dates and window boundaries are computed in UTC, like the SQL oracle.
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return normalize(fn(spark, sf_dir))


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: _run(name, fn, spark, sf_dir)
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].__name__ = name
        return fn
    return deco


# --------------------------------------------------------------------------
# Snapshot group (A1-A6) on customer-year detail
# --------------------------------------------------------------------------
STATS = ["gp", "pts", "reb", "ast"]
STATIC = ["c_mktsegment", "c_nationkey"]
KEY = "c_custkey"


def _snapshot(spark, sf_dir, end=si.SNAPSHOT_END):
    detail = si.customer_years(spark, sf_dir)
    return cum.backfill_snapshot(detail, KEY, "season", STATS, STATIC, end=end)


def _flat_snapshot(s: DataFrame) -> DataFrame:
    h = F.col(cum.HISTORY)
    return s.select(KEY, *STATIC, cum.CURRENT,
                    F.size(h).alias("n_seasons"),
                    join_ints(F.transform(h, lambda r: r["season"])).alias("seasons"),
                    F.element_at(h, -1)["pts"].alias("last_pts"),
                    cum.BAND, cum.GAP, cum.ACTIVE)


@register("backfill_snapshot")
def q_backfill_snapshot(spark, sf_dir):
    """A2: every customer-year snapshot row, first year to 2001."""
    return _flat_snapshot(_snapshot(spark, sf_dir))


@register("cumulate_snapshot")
def q_cumulate_snapshot(spark, sf_dir):
    """A1: 2000 snapshot merged with 2001 detail."""
    detail = si.customer_years(spark, sf_dir)
    prev = cum.backfill_snapshot(detail, KEY, "season", STATS, STATIC, end=si.SNAPSHOT_PREV)
    prev = prev.filter(F.col(cum.CURRENT) == si.SNAPSHOT_PREV)
    today = si.customer_years(spark, sf_dir, year=si.SNAPSHOT_END)
    return _flat_snapshot(cum.cumulate_snapshot(prev, today, KEY, "season", STATS, STATIC))


@register("unnest_history")
def q_unnest_history(spark, sf_dir):
    """A3: 2001 snapshot, one row per history element."""
    return cum.unnest_history(_snapshot(spark, sf_dir), KEY, si.SNAPSHOT_END)


@register("first_last_change")
def q_first_last_change(spark, sf_dir):
    """A4: first vs latest points per customer at 2001."""
    return cum.first_last_change(_snapshot(spark, sf_dir), KEY, si.SNAPSHOT_END, "pts")


TRACKED = [cum.BAND, cum.ACTIVE]


@register("scd2_backfill")
def q_scd2_backfill(spark, sf_dir):
    """A5: SCD2 intervals of (scoring_class, is_active) up to 2001."""
    return scd.scd2_backfill(_snapshot(spark, sf_dir), KEY, cum.CURRENT, TRACKED,
                             si.SNAPSHOT_END)


@register("scd2_backfill_sql")
def q_scd2_backfill_sql(spark, sf_dir):
    """A5 as SQL text over a temp view."""
    return scd.scd2_backfill_sql(spark, _snapshot(spark, sf_dir), KEY, cum.CURRENT,
                                 TRACKED, si.SNAPSHOT_END)


@register("scd2_incremental")
def q_scd2_incremental(spark, sf_dir):
    """SCD as of 2000 rolled forward with the 2001 snapshot."""
    snap = _snapshot(spark, sf_dir)
    prev = scd.scd2_backfill(snap, KEY, cum.CURRENT, TRACKED, si.SNAPSHOT_PREV)
    return scd.scd2_incremental(prev, snap, KEY, TRACKED, si.SNAPSHOT_PREV, si.SNAPSHOT_END)


# --------------------------------------------------------------------------
# Date lists, activity bits, metric arrays (A12-A16) on events
# --------------------------------------------------------------------------


def _flat_datelist(df, keys):
    return df.select(*keys, "date", F.size("dates_active").alias("n_dates"),
                     join_dates("dates_active").alias("dates_active"))


def _datelist_step(spark, sf_dir, keys, events=None, today=None):
    ev = si.events(spark, sf_dir) if events is None else events
    today = si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY) if today is None else today
    prev = cum.datelist_backfill(ev, keys, si.EVENT_PREV_DAY)
    return _flat_datelist(cum.cumulate_datelist(prev, today, keys, si.EVENT_DAY), keys)


@register("cumulate_datelist")
def q_cumulate_datelist(spark, sf_dir):
    """User date list on 2024-01-30 from the 2024-01-29 table."""
    return _datelist_step(spark, sf_dir, ["user_id"])


@register("cumulate_datelist_device")
def q_cumulate_datelist_device(spark, sf_dir):
    """A12 with a composite key (J2): user x device attributes."""
    dev = si.devices(spark, sf_dir)

    def with_dev(e):
        return e.join(dev, e.user_id == dev.device_id, "inner")
    return _datelist_step(spark, sf_dir, ["user_id", "os_type", "browser_type"],
                          with_dev(si.events(spark, sf_dir)),
                          with_dev(si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY)))


@register("cumulate_datelist_host")
def q_cumulate_datelist_host(spark, sf_dir):
    """A12 keyed by host (event_type stands in for host)."""
    ev = si.events(spark, sf_dir).withColumnRenamed("event_type", "host")
    today = si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY).withColumnRenamed("event_type", "host")
    return _datelist_step(spark, sf_dir, ["host"], ev, today)


@register("datelist_int")
def q_datelist_int(spark, sf_dir):
    """A13 + A14: 32-bit activity word and flags per user on 2024-01-30."""
    dl = cum.datelist_backfill(si.events(spark, sf_dir), "user_id", si.EVENT_DAY)
    return cum.datelist_int(dl, "user_id", si.EVENT_DAY)


def _arrays_through(spark, sf_dir, day):
    return cum.metric_array_backfill(si.events(spark, sf_dir), "user_id", day, "site_hits")


@register("cumulate_metric_array")
def q_cumulate_metric_array(spark, sf_dir):
    """Site-hit array per user, day 30 written into the 29th-day table."""
    ev = si.events(spark, sf_dir)
    prev = cum.metric_array_backfill(ev, "user_id", si.EVENT_PREV_DAY, "site_hits")
    today = si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY)
    out = cum.cumulate_metric_array(prev, today, "user_id", si.EVENT_DAY, "site_hits")
    return _flat_arrays(out, "user_id")


def _flat_arrays(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "month_start", "metric_name", F.size("metric_array").alias("n_days"),
                     join_ints("metric_array").alias("metric_array"))


@register("cumulate_metric_array_host")
def q_cumulate_metric_array_host(spark, sf_dir):
    """A15 host form: daily hits and daily distinct visitors per host, two
    arrays per host and month (event_type stands in for host)."""
    ev = si.events(spark, sf_dir).withColumnRenamed("event_type", "host")
    today = si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY).withColumnRenamed("event_type", "host")
    out = None
    for name, value in (("hits", F.count(F.lit(1))), ("unique_visitors", F.count_distinct("user_id"))):
        prev = cum.metric_array_backfill(ev, "host", si.EVENT_PREV_DAY, name, value=value)
        step = _flat_arrays(cum.cumulate_metric_array(prev, today, "host", si.EVENT_DAY, name, value=value), "host")
        out = step if out is None else out.unionByName(step)
    return out


@register("metric_array_daily")
def q_metric_array_daily(spark, sf_dir):
    """Arrays summed by index back to one row per day."""
    return cum.metric_array_daily(_arrays_through(spark, sf_dir, si.EVENT_DAY))


@register("monthly_hits_wide")
def q_monthly_hits_wide(spark, sf_dir):
    """A16 wide form: first three days per month."""
    return cum.monthly_hits_wide(_arrays_through(spark, sf_dir, si.EVENT_DAY))


# --------------------------------------------------------------------------
# Growth accounting, retention, lifecycle
# --------------------------------------------------------------------------
GROWTH_KEYS = ["user_id", "event_type"]


@register("growth_accounting")
def q_growth_accounting(spark, sf_dir):
    """(user, event type) growth states on 2024-01-30 from the 29th."""
    ev = si.events(spark, sf_dir, si.EVENT_MONTH_START, si.EVENT_PREV_DAY)
    prev = gr.growth_backfill(ev, GROWTH_KEYS, si.EVENT_MONTH_START, si.EVENT_PREV_DAY)
    today = si.events(spark, sf_dir, si.EVENT_DAY, si.EVENT_DAY)
    out = gr.growth_accounting(prev, today, GROWTH_KEYS, si.EVENT_DAY)
    return out.select(*GROWTH_KEYS, "first_active_date", "last_active_date",
                      "daily_active_state", "weekly_active_state",
                      join_dates("dates_active").alias("dates_active"), "date")


@register("retention")
def q_retention(spark, sf_dir):
    """Share active by days since first activity, whole month."""
    g = gr.growth_backfill(si.events(spark, sf_dir), GROWTH_KEYS, si.EVENT_MONTH_START,
                           si.EVENT_DAY, with_lists=False)
    return gr.retention(g)


@register("state_tracking")
def q_state_tracking(spark, sf_dir):
    """Customer lifecycle 2001 from the 2000 table."""
    active = si.customer_years(spark, sf_dir).select("c_custkey", "season")
    prev = gr.lifecycle_backfill(active, "c_custkey", "season", si.SNAPSHOT_PREV)
    today = si.customer_years(spark, sf_dir, year=si.SNAPSHOT_END).select("c_custkey", "season")
    out = gr.state_tracking(prev, today, "c_custkey", "season", si.SNAPSHOT_END)
    return out.select("c_custkey", "current_year", "first_active_year", "last_active_year",
                      "player_state", join_ints("years_active").alias("years_active"))


# --------------------------------------------------------------------------
# Facts and graph
# --------------------------------------------------------------------------


@register("dedup_rows")
def q_dedup_rows(spark, sf_dir):
    """Lineitem, one row per (l_orderkey, l_linenumber)."""
    li = table(spark, sf_dir, "lineitem")
    return fa.dedup_rows(li, ["l_orderkey", "l_linenumber"])


def _fact(spark, sf_dir):
    return fa.build_game_fact(si.game_details(spark, sf_dir), si.games(spark, sf_dir))


@register("build_game_fact")
def q_build_game_fact(spark, sf_dir):
    """A10: de-duplicated game fact with flags and minutes."""
    return _fact(spark, sf_dir)


@register("fact_ratio_summary")
def q_fact_ratio_summary(spark, sf_dir):
    """Games, points and 'not with team' share per player and home flag."""
    return fa.fact_ratio_summary(_fact(spark, sf_dir))


@register("graph_vertices")
def q_graph_vertices(spark, sf_dir):
    """Game, player and team vertices (JSON properties)."""
    g = si.scored_games(spark, sf_dir)
    home_wins = F.col("visitor_team_id").isNull() | (F.col("pts_home") > F.col("pts_away"))
    games_v = gp.vertices(g, "game_id", "game", {
        "status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"),
        "total_cents": cents("o_totalprice"), "home_team_id": F.col("home_team_id"),
        "pts_home": F.col("pts_home"), "pts_away": F.col("pts_away"),
        "winning_team": F.when(home_wins, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))})
    d = si.game_details(spark, sf_dir).withColumn("pts", F.col("pts").cast("long"))
    players_v = gp.player_vertices(d, "player_id", "game_id", "team_id", "player_name", "pts")
    n = table(spark, sf_dir, "nation")
    teams_v = gp.dedup_vertices(n, "n_nationkey", "team", {
        "abbreviation": F.col("n_name"), "region_id": F.col("n_regionkey")})
    teams_v = teams_v.withColumn("identifier", F.col("identifier").cast("long"))
    return games_v.unionByName(players_v).unionByName(teams_v)


@register("team_vertex_map")
def q_team_vertex_map(spark, sf_dir):
    """A7 map form: nation teams with map<string,string> properties
    (rendered as JSON text for the flat report)."""
    n = table(spark, sf_dir, "nation")
    v = gp.dedup_vertices(n, "n_nationkey", "team", {
        "abbreviation": F.col("n_name"), "region_id": F.col("n_regionkey")}, as_map=True)
    return v.select("identifier", "type", F.to_json("properties").alias("properties"))


@register("graph_edges")
def q_graph_edges(spark, sf_dir):
    """plays_in (player -> game) and plays_on (player -> team) edges."""
    d = si.game_details(spark, sf_dir)
    plays_in = gp.plays_in_edges(d, "player_id", "game_id", {
        "start_position": F.col("start_position"), "pts": F.col("pts").cast("long"),
        "team_id": F.col("team_id")})
    plays_on = gp.plays_on_edges(d, "player_id", "game_id", "team_id")
    return plays_in.unionByName(plays_on)


# --------------------------------------------------------------------------
# Analytical patterns
# --------------------------------------------------------------------------
@register("funnel")
def q_funnel(spark, sf_dir):
    """Later-same-day share reaching 'purchase', per event type."""
    return pt.funnel(si.events(spark, sf_dir), "event_type", "purchase", min_count=100)


DASH_DIMS = ["os_type", "device_type", "browser_type"]


@register("grouping_sets_dashboard")
def q_grouping_sets_dashboard(spark, sf_dir):
    """Hits by (browser, device, os), browser, os, device."""
    ev = si.events(spark, sf_dir)
    dev = si.devices(spark, sf_dir)
    aug = ev.join(dev, ev.user_id == dev.device_id, "inner").select(
        *[F.coalesce(F.col(d), F.lit("unknown")).alias(d) for d in DASH_DIMS], "user_id")
    return pt.grouping_sets_dashboard(
        aug, DASH_DIMS,
        [["browser_type", "device_type", "os_type"], ["browser_type"], ["os_type"], ["device_type"]],
        ["os_type__device_type__browser", "browser_type", "os_type", "device_type"],
        [F.count(F.lit(1)).alias("number_of_hits")])


@register("grouping_sets_player")
def q_grouping_sets_player(spark, sf_dir):
    """A21 player form: games and points by player-team, player-season, team."""
    g = si.games(spark, sf_dir).select("game_id", "season")
    d = si.game_details(spark, sf_dir).select("game_id", "player_name", "team_id", "pts")
    aug = g.join(d, "game_id", "left")
    return pt.grouping_sets_dashboard(
        aug, ["player_name", "team_id", "season"],
        [["player_name", "team_id"], ["player_name", "season"], ["team_id"]],
        ["player_team", "player_season", "team"],
        [F.count(F.lit(1)).alias("game_played"), F.sum("pts").alias("total_points")],
        overall=None)


@register("rolling_share")
def q_rolling_share(spark, sf_dir):
    """Referrer x url daily shares, groups with total > 500."""
    return pt.rolling_share(si.web_events(spark, sf_dir), min_total=500)


@register("rolling_share_unfiltered")
def q_rolling_share_unfiltered(spark, sf_dir):
    """A22 with no total threshold: every (referrer, url) group."""
    return pt.rolling_share(si.web_events(spark, sf_dir), min_total=0)


def _player_games(spark, sf_dir):
    f = _fact(spark, sf_dir)
    return f.select("dim_player_id", "dim_game_date", "dim_game_id", "m_pts")


STREAK_ORDER = ["dim_game_date", "dim_game_id"]
def _streak_chunk():
    return [F.col("dim_game_date"), F.floor(F.col("dim_game_id") / 65536)]


@register("longest_streak")
def q_longest_streak(spark, sf_dir):
    """Longest run of games with pts > 10, per player."""
    return pt.longest_streak(_player_games(spark, sf_dir), "dim_player_id", STREAK_ORDER,
                             _streak_chunk(), F.col("m_pts") > 10)


@register("longest_streak_top")
def q_longest_streak_top(spark, sf_dir):
    """A23 report form: the single longest streak (ties by player id)."""
    s = pt.longest_streak(_player_games(spark, sf_dir), "dim_player_id", STREAK_ORDER,
                          _streak_chunk(), F.col("m_pts") > 10)
    return s.orderBy(F.desc("longest_streak"), "dim_player_id").limit(1)


def _best_wins(spark, sf_dir):
    g = si.games(spark, sf_dir)
    return pt.best_rolling_wins(
        g, "home_team_id", ["game_date_est", "game_id"],
        [F.col("game_date_est"), F.floor(F.col("game_id") / 65536)],
        F.col("o_orderstatus") == "F", n=90)


@register("best_rolling_wins")
def q_best_rolling_wins(spark, sf_dir):
    """Most finished orders in any 90-order stretch, per nation."""
    return _best_wins(spark, sf_dir)


@register("best_rolling_wins_top")
def q_best_rolling_wins_top(spark, sf_dir):
    """A24 report form: the team with the most wins in a 90-game stretch
    (ties by team id)."""
    return _best_wins(spark, sf_dir).orderBy(F.desc("max_wins_90"), "home_team_id").limit(1)


# --------------------------------------------------------------------------
# Enrichment, layout, experiments, reports, contracts
# --------------------------------------------------------------------------


@register("events_with_devices")
def q_events_with_devices(spark, sf_dir):
    """A31 inner form: events with device attributes, browser upper-cased."""
    return en.events_with_devices(si.device_events(spark, sf_dir), si.page_devices(spark, sf_dir))


@register("events_with_devices_left")
def q_events_with_devices_left(spark, sf_dir):
    """A31 left form: events whose device is unknown keep null attributes."""
    return en.events_with_devices(si.device_events(spark, sf_dir), si.page_devices(spark, sf_dir),
                                  how="left")


def _rollup(spark, sf_dir):
    agg = lay.events_aggregated(si.device_events(spark, sf_dir))
    return lay.user_device_rollup(agg, si.page_devices(spark, sf_dir))


@register("user_device_rollup_users")
def q_user_device_rollup_users(spark, sf_dir):
    """Per user, max events on one device and the device list."""
    per_user, _ = _rollup(spark, sf_dir)
    return per_user.select("user_id", "max_event_counts", F.size("devices").alias("num_devices"),
                           join_ints("devices").alias("devices"))


@register("user_device_rollup_devices")
def q_user_device_rollup_devices(spark, sf_dir):
    """Per device, max events of one user and distinct users."""
    _, per_device = _rollup(spark, sf_dir)
    return per_device


@register("user_device_pairs")
def q_user_device_pairs(spark, sf_dir):
    """The users of each device with their event counts, one row each
    (a list per device would grow with the data)."""
    agg = lay.events_aggregated(si.device_events(spark, sf_dir))
    return lay.device_users(agg, si.page_devices(spark, sf_dir))


def _matches(spark, sf_dir):
    """Match stand-in joined to details: match = order, map = customer
    nation, playlist = order priority, player = supplier, kills = quantity,
    medal = part."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_gamertag"),
        F.col("l_quantity").alias("player_total_kills"), F.col("l_partkey").alias("medal_id"))
    g = si.games(spark, sf_dir).select(F.col("game_id").alias("match_id"),
                                       F.col("home_team_id").alias("mapid"),
                                       F.col("o_orderpriority").alias("playlist_id"))
    return li.join(g, "match_id", "inner")


@register("match_avg_kills")
def q_match_avg_kills(spark, sf_dir):
    """A28 (a): kills per game averaged over each player's matches."""
    return lay.avg_kills_per_game(_matches(spark, sf_dir))


@register("match_top_playlist")
def q_match_top_playlist(spark, sf_dir):
    """A28 (b): most played playlist."""
    return lay.top1(_matches(spark, sf_dir), "playlist_id")


@register("match_top_map")
def q_match_top_map(spark, sf_dir):
    """A28 (c): most played map."""
    return lay.top1(_matches(spark, sf_dir), "mapid")


@register("match_top_medal_map")
def q_match_top_medal_map(spark, sf_dir):
    """A28 (d): map with the most medals of one classification."""
    medals = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("medal_id"),
                                                 F.col("p_type").alias("classification"))
    return lay.medal_map_top(_matches(spark, sf_dir), medals, "PROMO")


#: A29 variants; the number of files comes from the table's bytes.
LINEITEM_LAYOUTS = {
    "unsorted": {},
    "sorted_shipdate": {"sort_within": ["l_shipdate"]},
    "by_supplier_sorted": {"by": ["l_suppkey"], "spread": False, "sort_within": ["l_suppkey", "l_shipdate"]},
    "by_supplier_spread": {"by": ["l_suppkey"], "sort_within": ["l_suppkey", "l_shipdate"]},
}
EVENT_LAYOUTS = {
    "by_day": {"by": ["event_date"], "spread": False, "partition_by": ["event_date"]},
    "by_day_sorted_type_user": {"by": ["event_date"], "partition_by": ["event_date"],
                                "sort_within": ["event_date", "event_type", "user_id"]},
    "by_day_sorted_user_type": {"by": ["event_date"], "partition_by": ["event_date"],
                                "sort_within": ["event_date", "user_id", "event_type"]},
}


@register("compare_layouts")
def q_compare_layouts(spark, sf_dir):
    """Lineitem written unsorted, sorted by ship date, and clustered by
    supplier with and without spreading; rows, keys, and what breaks the
    variant's promise."""
    return lay.layout_promises(spark, table(spark, sf_dir, "lineitem"), LINEITEM_LAYOUTS, "l_suppkey")


@register("compare_layouts_events")
def q_compare_layouts_events(spark, sf_dir):
    """A29 event form: events in day folders, locally sorted three ways."""
    ev = si.events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props",
                                         "ts", "event_date")
    return lay.layout_promises(spark, ev, EVENT_LAYOUTS, "event_date")


@register("versioned_upsert")
def q_versioned_upsert(spark, sf_dir):
    """K3: orders kept by year in a versioned table; the orders of two years
    arrive again with a new status, and new orders with them, as an upsert on
    (key, year) that becomes the next version."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus")
    t = VersionedTable(spark, scratch_path(spark, "orders"), "o_orderkey bigint, year int, o_orderstatus string", "year")
    t.upsert(o.where(F.col("o_orderkey") % 5 > 0), ["o_orderkey", "year"])
    late = o.where(F.col("year").between(1998, 1999)).withColumn("o_orderstatus", F.lit("X"))
    t.upsert(late, ["o_orderkey", "year"])
    return t.read()


@register("csv_ingest")
def q_csv_ingest(spark, sf_dir):
    """Events through CSV. The text is read with a schema, a column for
    what doesn't fit it and a contract; good and rejected rows are written in
    one pass and read back as one table."""
    ev = si.events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value", "props")
    # every hundredth value isn't a number, and every 97th event has no user
    text = ev.select("event_id", "ts", F.when(F.col("event_id") % 97 > 0, F.col("user_id")).alias("user_id"), "event_type",
                     F.when(F.col("event_id") % 100 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
                     "props")
    path = scratch_path(spark, "csv-in")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    text.write.option("header", True).option("escape", '"').option("timestampFormat", micros).csv(path)
    out = ingest.ingest_csv(spark, path, ingest.EVENT_CONTRACT, scratch_path(spark, "csv-out"), timestampFormat=micros)
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props", "accepted", "reasons")


@register("append_and_overwrite")
def q_append_and_overwrite(spark, sf_dir):
    """K1, K2: events by day, written in two appends; one day then arrives
    again with other values and replaces its partition alone."""
    ev = si.events(spark, sf_dir).select("event_id", "event_date", cents("value").alias("value_cents"))
    path = scratch_path(spark, "events-by-day")
    sinks.append(ev.where("event_date < '2024-01-15'"), path, ["event_date"])
    sinks.append(ev.where("event_date >= '2024-01-15'"), path, ["event_date"])
    again = ev.where("event_date = '2024-01-10'").withColumn("value_cents", F.col("value_cents") + 100)
    sinks.overwrite_partitions(again, path, ["event_date"])
    return spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("num_events"), F.sum("value_cents").alias("value_cents"))


@register("table_as_select")
def q_table_as_select(spark, sf_dir):
    """A catalog table made by CREATE TABLE AS SELECT in a
    namespace of its own, read back by name."""
    db = f"cumulus_ctas_{uuid.uuid4().hex[:12]}"
    sinks.create_namespace(spark, db, scratch_path(spark, "ctas"))
    daily = si.events(spark, sf_dir).groupBy("event_type", "event_date").agg(F.count(F.lit(1)).alias("num_events"))
    sinks.create_table_as(daily, f"{db}.daily_events")
    return catalog_table(spark, f"{db}.daily_events")


@register("partition_filter_in_join")
def q_partition_filter_in_join(spark, sf_dir):
    """Customers with their events of one day; the day is a condition of
    the join and reaches the scan as a partition filter."""
    path = scratch_path(spark, "events-for-join")
    sinks.write_partitioned(si.events(spark, sf_dir).select("event_id", "user_id", "event_date"), path, ["event_date"])
    part = spark.read.parquet(path)
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    on = (users.user_id == part.user_id) & (part.event_date == F.lit(si.EVENT_DAY).cast("date"))
    return users.join(part, on, "left").groupBy(users.user_id).agg(F.count("event_id").alias("num_events"))


@register("pair_join")
def q_pair_join(spark, sf_dir):
    """Events paired with their device as two whole rows."""
    pairs = pair_join(si.device_events(spark, sf_dir), si.page_devices(spark, sf_dir), ["device_id"])
    return pairs.select("_1.event_id", "_1.user_id", "_2.device_id", "_2.browser_type")


@register("json_events")
def q_json_events(spark, sf_dir):
    """Events as the JSON messages of a topic, parsed back to columns
    and a typed event time (milliseconds, UTC)."""
    ev = si.events(spark, sf_dir).select(
        F.concat(F.lit("/"), F.col("event_id")).alias("url"), F.col("event_type").alias("host"), si.user_ip().alias("ip"),
        F.date_format("ts", st.ISO_MILLIS_Z).alias("event_time"))
    value = ev.select(F.to_json(F.struct(*ev.columns)).cast("binary").alias("value"))
    return st.parse_json_events(value).select("url", "host", "ip", "event_timestamp")


@register("enrich_geo")
def q_enrich_geo(spark, sf_dir):
    """Events with an IP derived from the user, geodata from the
    nation ranges ('{}' when the IP is in no range)."""
    e = si.events(spark, sf_dir).select("event_id", "user_id", si.user_ip().alias("ip"))
    return en.enrich_geo(e, "ip", si.geo_ranges(spark, sf_dir), ["country", "state", "city"])


def _assign(spark, sf_dir):
    users = si.events(spark, sf_dir).select("user_id").distinct()
    return ex.assign_variant(users, "user_id", "checkout_redesign")


@register("assign_variant")
def q_assign_variant(spark, sf_dir):
    """Stable hash assignment of every event user to 3 cells."""
    return _assign(spark, sf_dir)


@register("experiment_readout")
def q_experiment_readout(spark, sf_dir):
    """Per-variant metrics, lift, z and t against control."""
    ev = si.events(spark, sf_dir)
    sess = sessionize_split(ev, "ts", ["user_id"], 1800).select(
        "user_id", (F.unix_micros("session_end") - F.unix_micros("session_start")
                    - 1800 * 1_000_000).alias("duration_us"))
    return ex.experiment_readout(lambda user: ex.variant_of(user, "checkout_redesign"), ev, sessions=sess)


def _profit_measures():
    rev = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long")
    exp_ = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * F.col("l_tax") * 100).cast("long")
    return {"revenue_cents": F.sum(rev), "expense_cents": F.sum(exp_),
            "profit_cents": F.sum(rev - exp_), "num_lines": F.count(F.lit(1))}


@register("period_report_monthly")
def q_period_report_monthly(spark, sf_dir):
    """Monthly revenue, expense (tax), profit and growth, by ship month."""
    return rp.period_report(table(spark, sf_dir, "lineitem"), "l_shipdate", "month", _profit_measures())


@register("period_report_weekly")
def q_period_report_weekly(spark, sf_dir):
    """The same by ship week."""
    return rp.period_report(table(spark, sf_dir, "lineitem"), "l_shipdate", "week", _profit_measures())


@register("period_report_daily")
def q_period_report_daily(spark, sf_dir):
    """The same by ship day."""
    return rp.period_report(table(spark, sf_dir, "lineitem"), "l_shipdate", "day", _profit_measures())


@register("engagement_monthly")
def q_engagement_monthly(spark, sf_dir):
    """A34 engagement: monthly active users, events and purchases, with growth."""
    return _engagement(spark, sf_dir, "month")


@register("growth_weekly")
def q_growth_weekly(spark, sf_dir):
    """A34 growth: the same user activity by week."""
    return _engagement(spark, sf_dir, "week")


def _engagement(spark, sf_dir, grain):
    return rp.period_report(si.events(spark, sf_dir), "ts", grain, {
        "active_users": F.count_distinct("user_id"), "events": F.count(F.lit(1)),
        "purchases": F.count_if(F.col("event_type") == "purchase")})


@register("validate_period")
def q_validate_period(spark, sf_dir):
    """Daily completeness and trend checks on orders by order date."""
    return rp.validate_period(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"],
                              "1995-01-01", "2001-08-01")


@register("cross_source_check")
def q_cross_source_check(spark, sf_dir):
    """A35 cross-source: orders per order day vs distinct lineitem orders
    per order day; days that differ."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    a = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    b = (li.join(o.select("o_orderkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
         .groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    return rp.cross_source_mismatch(a, b, ["day"], "n")


@register("contract_report")
def q_contract_report(spark, sf_dir):
    """Key uniqueness, not-null and domain checks on the snapshot."""
    snap = _snapshot(spark, sf_dir)
    return rp.contract_report(snap, [KEY, cum.CURRENT], not_null=[KEY, cum.CURRENT],
                              domains={cum.BAND: ["star", "good", "average", "bad"]})


# --------------------------------------------------------------------------
# Streaming (A25, A26; T1-T10)
# --------------------------------------------------------------------------


def _stream_events(spark, sf_dir):
    return st.file_events_stream(spark, sf_dir).withColumnRenamed("event_type", "host")


@register("tumbling_counts")
def q_tumbling_counts(spark, sf_dir):
    """5-minute hits per host from the event stream (watermark 15 s,
    update mode, epoch log + merge-on-read)."""
    s = st.with_event_time(_stream_events(spark, sf_dir), "ts")
    _, base = st.run_to_log(st.tumbling_counts(s, "ts", ["host"]), "update")
    return st.read_latest(spark, base, ["window_start", "host"])


@register("tumbling_counts_keyed")
def q_tumbling_counts_keyed(spark, sf_dir):
    """A25 second output: per host and referrer; the referrer comes from a
    stream-static join with pages."""
    s = st.with_event_time(_stream_events(spark, sf_dir), "ts")
    s = s.withColumn("_k", F.get_json_object("props", "$.k").cast("long"))
    p = table(spark, sf_dir, "pages").select(
        F.col("page_id"), F.try_parse_url(F.col("url"), F.lit("HOST")).alias("referrer"))
    s = s.join(p, s._k == p.page_id, "left")
    _, base = st.run_to_log(st.tumbling_counts(s, "ts", ["host", "referrer"]), "update")
    return st.read_latest(spark, base, ["window_start", "host", "referrer"])


def _sessions(spark, sf_dir, gap_seconds=300):
    e = si.events(spark, sf_dir).select(F.col("event_type").alias("host"),
                                        si.user_ip().alias("ip"), "ts")
    return sessionize_split(e, "ts", ["host", "ip"], gap_seconds)


@register("sessionize")
def q_sessionize(spark, sf_dir):
    """5-minute-gap sessions per host and ip (batch, hot keys split
    by hour buckets)."""
    return _sessions(spark, sf_dir)


@register("sessionize_native")
def q_sessionize_native(spark, sf_dir):
    """A26 with Spark's session_window (the streaming operator) on a batch."""
    e = si.events(spark, sf_dir).select(F.col("event_type").alias("host"),
                                        si.user_ip().alias("ip"), "ts")
    return st.sessionize(e, "ts", ["host", "ip"], st.WINDOW)


@register("sessionize_user_6h")
def q_sessionize_user_6h(spark, sf_dir):
    """A26 at a 6-hour gap by user ip only, where sessions hold many events
    and span many hour buckets."""
    e = si.events(spark, sf_dir).select(si.user_ip().alias("ip"), "ts")
    return sessionize_split(e, "ts", ["ip"], 6 * 3600)


@register("session_stats")
def q_session_stats(spark, sf_dir):
    """Mean events per session per host."""
    return st.session_stats(_sessions(spark, sf_dir), ["host"])


@register("session_stats_fine")
def q_session_stats_fine(spark, sf_dir):
    """T10 fine form: rounded mean hits per (ip, host, session start)."""
    return st.session_stats(_sessions(spark, sf_dir), ["ip", "host", "session_start"])


@register("session_stats_compare")
def q_session_stats_compare(spark, sf_dir):
    """T10 host comparison: hosts named in a list vs hosts matching a pattern."""
    return st.session_stats_by_group(_sessions(spark, sf_dir), {
        "in_list": F.col("host").isin("click", "view"),
        "like_pattern": F.col("host").like("%r%")})


@register("sessionize_stream")
def q_sessionize_stream(spark, sf_dir):
    """A26 streaming: session windows in append mode; a session is emitted
    once the watermark (max event time - 15 s) passes its end."""
    s = st.with_event_time(_stream_events(spark, sf_dir), "ts")
    s = s.select("host", si.user_ip().alias("ip"), "ts")
    _, base = st.run_to_log(st.sessionize(s, "ts", ["host", "ip"]), "append")
    return st.read_all(spark, base)


@register("session_updates_stream")
def q_session_updates_stream(spark, sf_dir):
    """A26 / T4 on a stream: every session, those that are still open too,
    with a flag for the ones that the watermark has closed."""
    s = _stream_events(spark, sf_dir).select("host", si.user_ip().alias("ip"), "ts")
    _, base = sess.run_sessions(sess.session_updates(s, "ts", ["host", "ip"], 300))
    out = sess.latest_sessions(spark, base, ["host", "ip"])
    return out.select("session_start", "session_end", "host", "ip", "num_hits",
                      (F.col("status") == sess.CLOSED).alias("closed"))


@register("two_outputs_stream")
def q_two_outputs_stream(spark, sf_dir):
    """Hits per host and per (host, referrer) from one streaming query
    that reads the source once and commits both under one epoch."""
    p = table(spark, sf_dir, "pages").select(
        F.col("page_id"), F.try_parse_url(F.col("url"), F.lit("HOST")).alias("referrer"))
    s = _stream_events(spark, sf_dir).withColumn("_k", F.get_json_object("props", "$.k").cast("long"))
    s = s.join(p, s._k == p.page_id, "left").select("host", "referrer", "ts")
    outputs = {"host": ["host"], "host_referrer": ["host", "referrer"]}
    _, base = st.run_fanout(s, {name: st.window_deltas("ts", keys) for name, keys in outputs.items()})
    parts = [st.summed_deltas(st.read_committed(spark, base, name), keys).select(
        F.lit(name).alias("output"), "window_start", "host",
        (F.col("referrer") if "referrer" in keys else F.lit(None).cast("string")).alias("referrer"), "num_hits")
        for name, keys in outputs.items()]
    return parts[0].unionByName(parts[1])


@register("enrich_geo_stream")
def q_enrich_geo_stream(spark, sf_dir):
    """Stateless projection + geo enrichment on the stream (append)."""
    s = _stream_events(spark, sf_dir).select("event_id", "user_id", si.user_ip().alias("ip"))
    out = en.enrich_geo(s, "ip", si.geo_ranges(spark, sf_dir), ["country", "state", "city"])
    _, base = st.run_to_log(out, "append")
    return st.read_all(spark, base)


# --------------------------------------------------------------------------
# Actor form of the snapshot and its SCD (A1/A2/A5 second form)
# --------------------------------------------------------------------------
FILM_COLS = ["filmid", "film", "votes", "rating"]


def _actor_score():
    # the mean is taken over integer cents (exact sums); the rating bands
    # are scaled to cents instead of dividing each rating
    return F.col("rating_cents")


def _actor_bands():
    from cumulus.functions.columns import RATING_BANDS
    return [(t * 5_000_000, label) for t, label in RATING_BANDS]


def _flat_actors(df):
    return df.select("actorid", "current_year", F.size("films").alias("n_films"),
                     join_ints(F.transform("films", lambda f: f["filmid"])).alias("film_ids"),
                     "quality_class", cum.ACTIVE)


@register("backfill_actor_films")
def q_backfill_actor_films(spark, sf_dir):
    """A2 actor form: every actor-year with all films so far."""
    return _flat_actors(cum.backfill_items(si.actor_films(spark, sf_dir), "actorid", "year",
                                           FILM_COLS, _actor_score(), si.SNAPSHOT_END,
                                           bands=_actor_bands()))


@register("cumulate_actor_films")
def q_cumulate_actor_films(spark, sf_dir):
    """A1 actor form: 2000 actor table + 2001 films."""
    films = si.actor_films(spark, sf_dir)
    prev = cum.backfill_items(films, "actorid", "year", FILM_COLS, _actor_score(), si.SNAPSHOT_PREV,
                              bands=_actor_bands())
    today = si.actor_films(spark, sf_dir, year=si.SNAPSHOT_END)
    return _flat_actors(cum.cumulate_items(prev, today, "actorid", "year", FILM_COLS,
                                           _actor_score(), si.SNAPSHOT_END, bands=_actor_bands()))


@register("actors_scd")
def q_actors_scd(spark, sf_dir):
    """A5 actor form: SCD2 of (quality_class, is_active) up to 2001."""
    snap = cum.backfill_items(si.actor_films(spark, sf_dir), "actorid", "year", FILM_COLS,
                              _actor_score(), si.SNAPSHOT_END, bands=_actor_bands())
    return scd.scd2_backfill(snap, "actorid", "current_year", ["quality_class", cum.ACTIVE],
                             si.SNAPSHOT_END, start_col="start_date", end_col="end_date",
                             current_col="current_year")


def _match_tables(spark, sf_dir):
    """Matches, match details and medal rows as three stand-in tables."""
    g = si.games(spark, sf_dir).select(F.col("game_id").alias("match_id"),
                                       F.col("home_team_id").alias("mapid"),
                                       F.col("o_orderpriority").alias("playlist_id"))
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_gamertag"),
        F.col("l_quantity").alias("kills"), F.col("l_partkey").alias("medal_id"))
    details = li.groupBy("match_id", "player_gamertag").agg(
        F.sum("kills").alias("player_total_kills"))
    medals_players = li.groupBy("match_id", "player_gamertag", "medal_id").agg(
        F.count(F.lit(1)).alias("count"))
    return g, details, medals_players


def _bucketed_match_rows(spark, sf_dir, buckets=None):
    g, details, medals_players = _match_tables(spark, sf_dir)
    t = lay.bucketed_tables(spark, {
        "games_by_match": (g, "match_id", ["match_id"]),
        "players_by_match": (details, "match_id", ["match_id"]),
        "medals_by_match": (medals_players, "match_id", ["match_id"])}, buckets)
    return lay.same_match_join(t["games_by_match"], t["players_by_match"], t["medals_by_match"])


@register("match_bucketed_playlists")
def q_match_bucketed_playlists(spark, sf_dir):
    """Matches, details and medal rows written bucketed by
    match_id, joined on the match and then the player without a shuffle; rows
    per playlist."""
    return _bucketed_match_rows(spark, sf_dir).groupBy("playlist_id").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("player_total_kills").alias("kills"))


@register("match_statistics")
def q_match_statistics(spark, sf_dir):
    """The four statistics over the three joined tables, with maps and
    medals as dimensions broadcast within a byte limit."""
    maps = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("mapid"),
                                                 F.col("n_name").alias("map_name"))
    medals = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("medal_id"),
                                                 F.col("p_type").alias("classification"))
    return lay.match_statistics(_bucketed_match_rows(spark, sf_dir), maps, medals, "PROMO")


@register("user_device_rollup_all")
def q_user_device_rollup_all(spark, sf_dir):
    """The three roll-ups from one aggregate, which is written once
    and read by all of them."""
    agg = lay.events_aggregated(si.device_events(spark, sf_dir)).select("user_id", "device_id", "event_counts")
    return lay.rollup_outputs(lay.written(agg, "device-agg"), si.page_devices(spark, sf_dir))
