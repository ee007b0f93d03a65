"""Physical-plan assertions: pruning and pushdown reach the scan, bounded
broadcasts are used, bucketed joins do not shuffle, chunked positions never
window over a whole key."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cumulus.operators import layout as lay
from cumulus.plans.catalog import QUERIES
from cumulus.plans import standins as si
from cumulus.sources.tables import table


def test_scan_prunes_columns_and_pushes_filters(spark, sf_small):
    df = table(spark, sf_small, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = lay.plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_schema_bounded_dimension_is_broadcast(spark, sf_small):
    assert lay.has_broadcast(si.devices(spark, sf_small))


def test_bucketed_join_has_no_exchange(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = table(spark, sf_small, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
        li = table(spark, sf_small, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
        j = lay.bucketed_join(spark, o, li, "k", buckets=16, db="cumulus_test_layout")
        plan = lay.plan_text(j, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
        # The same join on the unbucketed inputs shuffles both sides
        assert lay.plan_text(o.join(li, "k"), "simple").count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_positions_window_is_chunked(spark, sf_small):
    df = E.queries()["best_rolling_wins"](spark, sf_small)
    plan = lay.plan_text(df, "simple")
    # every Window is partitioned by more than the team key alone
    for line in plan.splitlines():
        if line.strip().startswith("+- Window") or line.strip().startswith("Window"):
            assert "home_team_id" in line
            assert "_c0" in line or "_c1" in line or "[home_team_id#" not in line.split("]")[-1]


def test_dedup_limits_groups_before_the_shuffle(spark, sf_small):
    plan = lay.plan_text(E.queries()["dedup_rows"](spark, sf_small), "simple")
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit") < shuffle < plan.rindex("WindowGroupLimit")
    assert "Final" in plan[:shuffle] and "Partial" in plan[shuffle:]


def test_partition_filter_inside_join_condition_prunes(spark, sf_small):
    """A literal on the partition column inside ON reaches the scan
    as a partition filter."""
    from cumulus.session import scratch_path
    from cumulus.sources import sinks
    path = scratch_path(spark, "j14")
    ev = table(spark, sf_small, "events").select("user_id", "event_type", F.to_date("ts").alias("event_date"))
    sinks.write_partitioned(ev, path, ["event_date"])
    part = spark.read.parquet(path)
    users = table(spark, sf_small, "customer").select(F.col("c_custkey").alias("user_id"))
    j = users.join(part, (users.user_id == part.user_id) & (part.event_date == F.lit("2024-01-05").cast("date")))
    plan = lay.plan_text(j)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan


def test_pair_join_keeps_whole_rows(spark):
    from cumulus.operators.joins import pair_join
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(1, 10.0)], "id long, w double")
    r = pair_join(a, b, ["id"]).collect()
    assert len(r) == 1 and r[0]["_1"]["v"] == "x" and r[0]["_2"]["w"] == 10.0


def test_global_sort_shuffles_local_sort_does_not(spark, sf_small):
    ev = table(spark, sf_small, "events").repartition(4, "user_id")
    glob = lay.plan_text(ev.orderBy("user_id", "ts"), "simple")
    local = lay.plan_text(ev.sortWithinPartitions("user_id", "ts"), "simple")
    assert "Exchange rangepartitioning" in glob
    assert "rangepartitioning" not in local and "Sort [" in local


@pytest.mark.parametrize("buckets", [None, 8, 32])
def test_three_table_bucketed_join_has_no_exchange_at_any_count(spark, sf_small, buckets):
    from cumulus.plans.catalog import _bucketed_match_rows, _match_tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = _bucketed_match_rows(spark, sf_small, buckets)
        plan = lay.plan_text(j, "simple")
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        assert "Bucketed: true" in lay.plan_text(j) and f"SelectedBucketsCount: {buckets or 4} out of {buckets or 4}" in lay.plan_text(j)
        # The unbucketed twin shuffles, and has the same rows
        g, details, mp = _match_tables(spark, sf_small)
        twin = g.join(details, "match_id").join(mp, ["match_id", "player_gamertag"])
        assert lay.plan_text(twin, "simple").count("Exchange hashpartitioning") >= 3
        cols = sorted(twin.columns)
        assert j.select(cols).exceptAll(twin.select(cols)).isEmpty() and twin.count() == j.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queries_leave_the_session_alone(spark, sf_small):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, "false")
    try:
        E.queries()["match_bucketed_playlists"](spark, sf_small)
        E.queries()["funnel"](spark, sf_small)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_broadcast_is_refused_above_the_limit(spark, sf_small):
    from cumulus.operators.joins import BroadcastTooLarge, broadcast_within, plan_bytes, star_join
    nation, li = table(spark, sf_small, "nation"), table(spark, sf_small, "lineitem")
    assert 0 < plan_bytes(nation) < plan_bytes(li)
    broadcast_within(nation, plan_bytes(nation))
    with pytest.raises(BroadcastTooLarge):
        broadcast_within(li, plan_bytes(li) - 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = table(spark, sf_small, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
        dim = nation.select("n_nationkey", "n_name")
        assert "BroadcastHashJoin" in lay.plan_text(star_join(fact, [(dim, "n_nationkey")]), "simple")
        small = star_join(fact, [(dim, "n_nationkey")], limit=1)
        assert "BroadcastHashJoin" not in lay.plan_text(small, "simple") and small.count() == fact.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_match_statistics_broadcast_the_map_dimension(spark, sf_small):
    from cumulus.plans.catalog import _bucketed_match_rows
    from cumulus.operators.joins import star_join
    maps = table(spark, sf_small, "nation").select(F.col("n_nationkey").cast("long").alias("mapid"), F.col("n_name").alias("map_name"))
    plan = lay.plan_text(star_join(_bucketed_match_rows(spark, sf_small), [(maps, "mapid")]), "simple")
    assert "BroadcastHashJoin [mapid" in plan and "Exchange hashpartitioning" not in plan


def test_rollups_share_one_aggregate(spark, sf_small):
    plan = lay.plan_text(E.queries()["user_device_rollup_all"](spark, sf_small))
    assert "events.parquet" not in plan  # three outputs, all from the written aggregate
    agg = lay.events_aggregated(si.device_events(spark, sf_small))
    with lay.shared(agg) as held:
        assert held.storageLevel.useDisk and held.storageLevel.useMemory
        assert "InMemoryTableScan" in lay.plan_text(held.groupBy("user_id").count(), "simple")
    assert not agg.storageLevel.useMemory


def test_no_python_no_cartesian_in_any_registered_plan(spark, sf_small):
    """Every registered query stays JVM-side and never pairs all rows."""
    skip = {"compare_layouts", "compare_layouts_events"}   # write files while being built
    for name, q in QUERIES.items():
        if name in skip or "stream" in name or name.startswith("tumbling") or name in (
                "match_bucketed_playlists", "match_statistics", "versioned_upsert", "csv_ingest", "append_and_overwrite",
                "table_as_select", "partition_filter_in_join"):
            continue
        plan = lay.plan_text(q(spark, sf_small), "simple")
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                    "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_bucketed_query_can_be_built_twice(spark, sf_small):
    first = QUERIES["match_bucketed_playlists"](spark, sf_small)
    QUERIES["match_bucketed_playlists"](spark, sf_small)
    assert first.count() > 0


def test_rolling_wins_make_positions_once(spark, sf_small):
    plan = lay.plan_text(E.queries()["best_rolling_wins"](spark, sf_small), "simple")
    assert plan.count("orders.parquet") <= 3 and plan.count("row_number()") == 1


def test_batch_sessions_need_two_shuffles_and_no_join(spark, sf_small):
    plan = lay.plan_text(E.queries()["sessionize"](spark, sf_small), "simple")
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_readout_joins_no_assignment(spark, sf_small):
    plan = lay.plan_text(E.queries()["experiment_readout"](spark, sf_small), "simple")
    assert plan.count("Join") == 1  # the variants' session lengths, a handful of rows


def test_registered_join_prunes_partitions(spark, sf_small):
    plan = lay.plan_text(E.queries()["partition_filter_in_join"](spark, sf_small))
    assert "PartitionFilters: [isnotnull(event_date" in plan and si.EVENT_DAY in plan
