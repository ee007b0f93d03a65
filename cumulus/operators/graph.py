"""Property-graph tables (A7 vertices, A8 edges).

Vertices: (identifier, type, properties); edges: (subject_identifier,
subject_type, object_identifier, object_type, edge_type, properties).
Properties are JSON text that keeps null fields, or a string map.

Edge types that would pair every two players of one game (plays_against,
shares_team) are declared by the reference but never filled; they are
not generated here because their size is quadratic in the group size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.functions.columns import json_object, string_map
from cumulus.operators.facts import dedup_rows

VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def vertices(df: DataFrame, id_col: str, vtype: str, props: Mapping[str, Column],
             as_map: bool = False) -> DataFrame:
    """Generic vertex rows; ``props`` maps property name -> column."""
    p = string_map(**props) if as_map else json_object(**props)
    return df.select(F.col(id_col).alias("identifier"), F.lit(vtype).alias("type"),
                     p.alias("properties"))


def dedup_vertices(df: DataFrame, id_col: str, vtype: str, props: Mapping[str, Column],
                   as_map: bool = False) -> DataFrame:
    """A7 team form: one vertex per id (duplicates collapse)."""
    return vertices(dedup_rows(df, [id_col]), id_col, vtype, props, as_map)


def player_vertices(details: DataFrame, player_key: str, game_key: str, team_key: str,
                    name_col: str, pts_col: str) -> DataFrame:
    """A7 player form: de-duplicated (player, game) rows aggregated to
    name, games, points and the sorted distinct team list."""
    d = dedup_rows(details.select(player_key, game_key, team_key, name_col, pts_col),
                   [player_key, game_key])
    agg = d.groupBy(player_key).agg(
        F.max(name_col).alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum(pts_col).alias("total_points"),
        F.array_sort(F.collect_set(team_key)).alias("teams"))
    return vertices(agg, player_key, "player", {
        "player_name": F.col("player_name"),
        "number_of_games": F.col("number_of_games"),
        "total_points": F.col("total_points"),
        "teams": F.col("teams")})


def edges(df: DataFrame, subject: str, subject_type: str, obj: str, object_type: str,
          edge_type: str, props: Mapping[str, Column]) -> DataFrame:
    return df.select(F.col(subject).alias("subject_identifier"),
                     F.lit(subject_type).alias("subject_type"),
                     F.col(obj).alias("object_identifier"),
                     F.lit(object_type).alias("object_type"),
                     F.lit(edge_type).alias("edge_type"),
                     json_object(**props).alias("properties"))


def plays_in_edges(details: DataFrame, player_key: str, game_key: str,
                   props: Mapping[str, Column]) -> DataFrame:
    """Player -> game edges from de-duplicated (player, game) rows."""
    d = dedup_rows(details, [player_key, game_key])
    return edges(d, player_key, "player", game_key, "game", "plays_in", props)


def plays_on_edges(details: DataFrame, player_key: str, game_key: str,
                   team_key: str) -> DataFrame:
    """Player -> team edges, one per distinct pair, with game count
    (a partial/final aggregate)."""
    d = details.groupBy(player_key, team_key).agg(F.count_distinct(game_key).alias("num_games"))
    return edges(d, player_key, "player", team_key, "team", "plays_on",
                 {"num_games": F.col("num_games")})
