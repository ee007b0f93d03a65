"""cumulus: analytics patterns (cumulative snapshots, SCD2, datelists,
growth accounting, funnels, rolling windows, sessionized streams, layout
studies, experiment read-outs) as pure DataFrame -> DataFrame functions
on Spark's own optimizer and execution engine.

Entry points by area (all in ``cumulus.operators`` unless noted):

* cumulative: cumulate_snapshot, backfill_snapshot, unnest_history,
  first_last_change, cumulate_items, backfill_items, cumulate_datelist,
  datelist_backfill, datelist_int, cumulate_metric_array,
  metric_array_backfill, metric_array_daily, monthly_hits_wide
* scd: scd2_backfill, scd2_backfill_sql, scd2_incremental
* growth: growth_accounting, growth_backfill, retention, state_tracking,
  lifecycle_backfill
* facts / graph: dedup_rows, build_game_fact, fact_ratio_summary,
  vertices, player_vertices, dedup_vertices, plays_in_edges, plays_on_edges
* patterns: funnel, grouping_sets_dashboard, rolling_share,
  longest_streak, best_rolling_wins; joins: positions, bounded_dim,
  pair_join; sessions: sessionize_split
* enrich: enrich_geo, events_with_devices; layout: bucketed_join,
  bucketed_tables, compare_layouts, user_device_rollup, top1
* experiment: assign_variant, experiment_readout; reports: period_report,
  validate_period, cross_source_mismatch, contract_report
* cumulus.streaming.streams: tumbling_counts, sessionize, session_stats,
  run_to_log, read_latest, compact_log, kafka_reader, parse_json_events
* cumulus.sources: tables (scans), sinks (writes); cumulus.plans.jobs
"""

from cumulus.session import checkpoint_root, get_session, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
