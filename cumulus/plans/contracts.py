"""The contract of each registered output table: its key (unique),
columns that must not be null, and enum domains. Checked by
``reports.contract_report`` / ``assert_contract``."""

from __future__ import annotations

from cumulus.operators.graph import EDGE_TYPES, VERTEX_TYPES
from cumulus.operators.growth import (CHURNED, L_CONTINUED, L_NEW, L_RETIRED, L_RETURNED,
                                      L_STAYED, NEW, RESURRECTED, RETAINED, STALE)

# Scoring / quality classes of the snapshot tables.
CLASSES = ["star", "good", "average", "bad"]
GROWTH = [NEW, RETAINED, RESURRECTED, CHURNED, STALE]
LIFECYCLE = [L_NEW, L_RETIRED, L_CONTINUED, L_RETURNED, L_STAYED]


def c(keys, not_null=None, domains=None):
    return {"keys": list(keys), "not_null": list(not_null if not_null is not None else keys),
            "domains": domains or {}}


CONTRACTS = {
    "backfill_snapshot": c(["c_custkey", "current_season"], domains={"scoring_class": CLASSES}),
    "cumulate_snapshot": c(["c_custkey"], ["c_custkey", "current_season"], {"scoring_class": CLASSES}),
    "unnest_history": c(["c_custkey", "season"]),
    "first_last_change": c(["c_custkey"]),
    "scd2_backfill": c(["c_custkey", "start_season"], domains={"scoring_class": CLASSES}),
    "scd2_backfill_sql": c(["c_custkey", "start_season"], domains={"scoring_class": CLASSES}),
    "scd2_incremental": c(["c_custkey", "start_season"], domains={"scoring_class": CLASSES}),
    "backfill_actor_films": c(["actorid", "current_year"], domains={"quality_class": CLASSES}),
    "cumulate_actor_films": c(["actorid"], domains={"quality_class": CLASSES}),
    "actors_scd": c(["actorid", "start_date"], domains={"quality_class": CLASSES}),
    "cumulate_datelist": c(["user_id", "date"]),
    "cumulate_datelist_device": c(["user_id", "os_type", "browser_type", "date"]),
    "cumulate_datelist_host": c(["host", "date"]),
    "datelist_int": c(["user_id"]),
    "cumulate_metric_array": c(["user_id", "month_start", "metric_name"]),
    "cumulate_metric_array_host": c(["host", "month_start", "metric_name"]),
    "metric_array_daily": c(["metric_name", "date"]),
    "monthly_hits_wide": c(["month_start"]),
    "growth_accounting": c(["user_id", "event_type", "date"],
                           domains={"daily_active_state": GROWTH, "weekly_active_state": GROWTH}),
    "retention": c(["days_since_first_active"]),
    "state_tracking": c(["c_custkey", "current_year"], domains={"player_state": LIFECYCLE}),
    "dedup_rows": c(["l_orderkey", "l_linenumber"]),
    "build_game_fact": c(["dim_game_id", "dim_team_id", "dim_player_id"]),
    "graph_vertices": c(["identifier", "type"], domains={"type": list(VERTEX_TYPES)}),
    "team_vertex_map": c(["identifier"]),
    "graph_edges": c(["subject_identifier", "object_identifier", "edge_type"],
                     domains={"edge_type": list(EDGE_TYPES)}),
    "funnel": c(["event_type"]),
    "grouping_sets_dashboard": c(["aggregation_level", "os_type", "device_type", "browser_type"]),
    "longest_streak": c(["dim_player_id"]),
    "best_rolling_wins": c(["home_team_id"]),
    "events_with_devices": c(["event_id"]),
    "user_device_rollup_users": c(["user_id"]),
    "user_device_pairs": c(["device_id", "user_id"]),
    "user_device_rollup_devices": c(["device_id"]),
    "match_avg_kills": c(["player_gamertag"]),
    "enrich_geo": c(["event_id"], ["event_id", "geodata"]),
    "assign_variant": c(["user_id"], domains={"variant": ["control", "test_a", "test_b"]}),
    "experiment_readout": c(["variant"]),
    "period_report_monthly": c(["period_start"]),
    "period_report_daily": c(["period_start"]),
    "growth_weekly": c(["period_start"]),
    "period_report_weekly": c(["period_start"]),
    "engagement_monthly": c(["period_start"]),
    "validate_period": c(["day"]),
    "tumbling_counts": c(["window_start", "host"]),
    "sessionize": c(["host", "ip", "session_start"]),
    "sessionize_native": c(["host", "ip", "session_start"]),
    "sessionize_user_6h": c(["ip", "session_start"]),
    "session_stats": c(["host"]),
    "enrich_geo_stream": c(["event_id"]),
    "sessionize_stream": c(["host", "ip", "session_start"]),
    "session_updates_stream": c(["host", "ip", "session_start"], ["host", "ip", "session_start", "session_end", "closed"]),
    "two_outputs_stream": c(["output", "window_start", "host", "referrer"], ["output", "window_start", "host", "num_hits"],
                            {"output": ["host", "host_referrer"]}),
    "tumbling_counts_keyed": c(["window_start", "host", "referrer"], ["window_start", "host", "num_hits"]),
    "session_stats_compare": c(["host_group"]),
    "session_stats_fine": c(["host", "ip", "session_start"]),
    "best_rolling_wins_top": c(["home_team_id"], ["home_team_id", "max_wins_90"]),
    "longest_streak_top": c(["dim_player_id"], ["dim_player_id", "longest_streak"]),
    "match_bucketed_playlists": c(["playlist_id"]),
    "match_top_map": c(["mapid"]),
    "match_top_medal_map": c(["mapid"]),
    "match_top_playlist": c(["playlist_id"]),
    "compare_layouts": c(["variant"], ["variant", "n_rows", "n_keys"]),
    "compare_layouts_events": c(["variant"], ["variant", "n_rows", "n_keys"]),
    "append_and_overwrite": c(["event_date"], ["event_date", "num_events", "value_cents"]),
    "table_as_select": c(["event_type", "event_date"]),
    "partition_filter_in_join": c(["user_id"], ["user_id", "num_events"]),
    "pair_join": c(["event_id", "device_id"]),
    "json_events": c(["url"], ["url", "host", "ip", "event_timestamp"]),
    "versioned_upsert": c(["o_orderkey"], ["o_orderkey", "year", "o_orderstatus"]),
    "csv_ingest": c(["event_id"], ["event_id", "accepted", "reasons"]),
    "match_statistics": c(["statistic"], ["statistic", "value"]),
    "user_device_rollup_all": c(["output", "device_id", "user_id"], ["output", "max_event_counts", "n"],
                                {"output": ["user", "device", "pair"]}),
    "contract_report": c(["check"], ["check", "violations"]),
    "cross_source_check": c(["day"]),
    "events_with_devices_left": c(["event_id"]),
    "fact_ratio_summary": c(["dim_player_name", "dim_is_playing_at_home"]),
    "grouping_sets_player": c(["aggregation_level", "player_name", "team_id", "season"], ["aggregation_level"]),
    "rolling_share": c(["referrer", "url", "event_date"]),
    "rolling_share_unfiltered": c(["referrer", "url", "event_date"]),
}
