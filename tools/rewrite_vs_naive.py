"""Time four rewrites against a plain transcription of the same query, on
the same tables (median of repeated runs after one warm-up, noop sink).

* funnel: self join on (user, day, later time) vs per-(user, day) aggregate
* activity bits: cross join with a date series vs one fold per key
* season spine: theta join with a year series + running collect_list vs
  per-key sequence + explode
* incremental SCD2: four-branch UNION ALL vs one full outer join + explode

Usage: python tools/rewrite_vs_naive.py [sf_dir] [repeat]
Prints one JSON line; results are equal row for row (checked).
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cumulus.operators import cumulative as cum  # noqa: E402
from cumulus.operators import patterns as pt  # noqa: E402
from cumulus.operators import scd  # noqa: E402
from cumulus.plans import standins as si  # noqa: E402
from cumulus.session import get_session  # noqa: E402

NAIVE_FUNNEL = """
WITH e AS (SELECT DISTINCT user_id, ts, event_type, event_date FROM ev),
c AS (
  SELECT a.user_id, a.ts, a.event_type,
         COUNT(DISTINCT CASE WHEN b.event_type = 'purchase' THEN b.event_type END) AS converted
  FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_date = b.event_date AND b.ts > a.ts
  GROUP BY a.user_id, a.ts, a.event_type
)
SELECT event_type, COUNT(1) AS num_events, CAST(SUM(converted) AS DOUBLE) / COUNT(1) AS conversion_rate
FROM c GROUP BY event_type
HAVING CAST(SUM(converted) AS DOUBLE) / COUNT(1) > 0 AND COUNT(1) > 100
"""

NAIVE_BITS = """
WITH s AS (SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-30', INTERVAL 1 DAY)) AS d)
SELECT user_id,
       CAST(SUM(CASE WHEN array_contains(dates_active, s.d)
                THEN CAST(pow(2, 31 - datediff(DATE'2024-01-30', s.d)) AS BIGINT) ELSE 0 END) AS BIGINT) AS datelist_int
FROM dl CROSS JOIN s GROUP BY user_id
"""

NAIVE_SPINE = """
WITH years AS (SELECT explode(sequence(1995, 2001)) AS season),
firsts AS (SELECT c_custkey, MIN(season) AS first_season FROM detail GROUP BY c_custkey),
spine AS (SELECT f.c_custkey, y.season FROM firsts f JOIN years y ON f.first_season <= y.season),
w AS (
  SELECT s.c_custkey, s.season AS current_season,
         collect_list(CASE WHEN d.season IS NOT NULL THEN named_struct('season', d.season, 'pts', d.pts) END)
           OVER (PARTITION BY s.c_custkey ORDER BY s.season) AS season_stats
  FROM spine s LEFT JOIN detail d ON s.c_custkey = d.c_custkey AND s.season = d.season
)
SELECT c_custkey, current_season, size(season_stats) AS n FROM w
"""

NAIVE_SCD = """
WITH last AS (SELECT * FROM prev WHERE end_season = 2000),
hist AS (SELECT c_custkey, scoring_class, is_active, start_season, end_season FROM prev WHERE end_season < 2000),
t AS (SELECT * FROM snap WHERE current_season = 2001),
unchanged AS (
  SELECT t.c_custkey, t.scoring_class, t.is_active, l.start_season, t.current_season AS end_season
  FROM t JOIN last l ON t.c_custkey = l.c_custkey
  WHERE t.scoring_class <=> l.scoring_class AND t.is_active <=> l.is_active),
changed AS (
  SELECT t.c_custkey, inline(array(
           named_struct('scoring_class', l.scoring_class, 'is_active', l.is_active,
                        'start_season', l.start_season, 'end_season', l.end_season),
           named_struct('scoring_class', t.scoring_class, 'is_active', t.is_active,
                        'start_season', t.current_season, 'end_season', t.current_season)))
  FROM t JOIN last l ON t.c_custkey = l.c_custkey
  WHERE NOT (t.scoring_class <=> l.scoring_class) OR NOT (t.is_active <=> l.is_active)),
new AS (
  SELECT t.c_custkey, t.scoring_class, t.is_active, t.current_season AS start_season,
         t.current_season AS end_season
  FROM t LEFT ANTI JOIN last l ON t.c_custkey = l.c_custkey),
gone AS (SELECT l.c_custkey, l.scoring_class, l.is_active, l.start_season, l.end_season
         FROM last l LEFT ANTI JOIN t ON t.c_custkey = l.c_custkey)
SELECT * FROM hist UNION ALL SELECT * FROM unchanged UNION ALL SELECT * FROM changed
UNION ALL SELECT * FROM new UNION ALL SELECT * FROM gone
"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = get_session("local[8]", app="cumulus-rewrites", shuffle_partitions=16)
    ev = si.events(spark, sf_dir)
    ev.createOrReplaceTempView("ev")
    dl = cum.datelist_backfill(ev, "user_id", "2024-01-30")
    dl.createOrReplaceTempView("dl")
    detail = si.customer_years(spark, sf_dir)
    detail.createOrReplaceTempView("detail")
    snap = cum.backfill_snapshot(detail, "c_custkey", "season", ["gp", "pts", "reb", "ast"], end=2001)
    snap.createOrReplaceTempView("snap")
    tracked = ["scoring_class", "is_active"]
    prev = scd.scd2_backfill(snap, "c_custkey", "current_season", tracked, 2000)
    prev.createOrReplaceTempView("prev")

    pairs = {
        "funnel": (spark.sql(NAIVE_FUNNEL),
                   pt.funnel(ev, "event_type", "purchase", min_count=100)),
        "activity_bits": (spark.sql(NAIVE_BITS),
                          cum.datelist_int(dl, "user_id", "2024-01-30").select("user_id", "datelist_int")),
        "season_spine": (spark.sql(NAIVE_SPINE),
                         cum.backfill_snapshot(detail, "c_custkey", "season", ["pts"], end=2001)
                         .select("c_custkey", "current_season", F.size("season_stats").alias("n"))),
        "scd_incremental": (spark.sql(NAIVE_SCD),
                            scd.scd2_incremental(prev, snap, "c_custkey", tracked, 2000, 2001)
                            .drop("current_season")),
    }

    def timed(df) -> float:
        df.write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        return round(statistics.median(runs), 3)

    out = {}
    for name, (naive, rewrite) in pairs.items():
        same = (naive.exceptAll(rewrite.select(*naive.columns)).count() == 0
                and rewrite.select(*naive.columns).exceptAll(naive).count() == 0)
        out[name] = {"naive_sec": timed(naive), "rewrite_sec": timed(rewrite), "equal": same}
    print(json.dumps({"sf_dir": sf_dir, "repeat": repeat, "cpus": 8, "results": out}))


if __name__ == "__main__":
    main()
