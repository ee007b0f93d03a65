"""Fact de-duplication and fact tables.

De-duplication keeps, per key, the row that sorts first by the given
columns: rank one of a window. Spark turns the rank filter into a group limit
that runs before the shuffle too, so each task sends one row of a key, however
many copies it has, and no key is sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cumulus.functions.columns import contains_flag, minutes_from_mmss, safe_ratio


def dedup_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
               keep: str = "first") -> DataFrame:
    """One row per key; ``order_by`` (default: all other columns)
    decides which row is kept (ascending, nulls first; ``keep="last"`` for
    descending); ties are broken by the remaining columns, so the result
    is deterministic."""
    ks = list(keys)
    rest = [c for c in df.columns if c not in ks]
    order = list(order_by) if order_by else rest
    tail = [c for c in rest if c not in order]
    by = [F.asc(c) if keep == "first" else F.desc(c) for c in order + tail]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*ks).orderBy(*by)))
    return ranked.where(F.col("_rank") == 1).select(*ks, *rest)


# Comment markers of the game fact flags.
DID_NOT_PLAY, DID_NOT_DRESS, NOT_WITH_TEAM = "DNP", "DND", "NWT"


def build_game_fact(details: DataFrame, games: DataFrame, game_key: str = "game_id",
                    player_key: str = "player_id", team_key: str = "team_id") -> DataFrame:
    """A10: de-duplicate details per (player, game, team), join the game
    (date, season, home team), derive the flags from the comment text and
    minutes from 'mm:ss', rename to dim_/m_ columns.

    ``details``: game_id, player_id, team_id, player_name, start_position,
    comment, min, pts. ``games``: game_id, game_date_est, season,
    home_team_id.
    """
    d = dedup_rows(details, [player_key, game_key, team_key])
    g = games.select(game_key, "game_date_est", "season", "home_team_id")
    j = d.join(g, game_key, "inner")
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col(team_key).alias("dim_team_id"),
        F.col(player_key).alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col(team_key) == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        contains_flag("comment", DID_NOT_PLAY).alias("dim_did_not_play"),
        contains_flag("comment", DID_NOT_DRESS).alias("dim_did_not_dress"),
        contains_flag("comment", NOT_WITH_TEAM).alias("dim_not_with_team"),
        minutes_from_mmss("min").alias("m_minutes"),
        F.col("pts").alias("m_pts"),
        F.col(game_key).alias("dim_game_id"))


def fact_ratio_summary(fact: DataFrame) -> DataFrame:
    """Per player and home flag: games, points, games flagged "not
    with team" and their share."""
    return (fact.groupBy("dim_player_name", "dim_is_playing_at_home")
            .agg(F.count(F.lit(1)).alias("num_games"),
                 F.sum("m_pts").alias("total_points"),
                 F.count_if(F.col("dim_not_with_team")).alias("bailed_num"))
            .withColumn("bail_pct", safe_ratio("bailed_num", "num_games")))
