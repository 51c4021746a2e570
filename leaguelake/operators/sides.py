"""Split a game into the rows of the two teams that played it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions import beats
from leaguelake.operators.lanes import Timeline

# Ties on the date are ordered by game id, so every run sees the same order.
TEAM_GAMES = Timeline(entity=("team_id",), day="game_date", ties=("game_id",))


def _side(team: str, opponent: str, scored: str, conceded: str, is_home: int) -> Column:
    return F.struct(
        F.col(team).alias("team_id"),
        F.col(opponent).alias("opponent_id"),
        F.col(scored).alias("points_for"),
        F.col(conceded).alias("points_against"),
        F.lit(is_home).alias("is_home"),
        beats(F.col(scored), F.col(conceded)).alias("is_win"),
    )


def side_split(games: DataFrame) -> DataFrame:
    """Home row and away row of every game, from one scan of the games."""
    home = _side("home_team_id", "visitor_team_id", "home_team_score", "visitor_team_score", 1)
    away = _side("visitor_team_id", "home_team_id", "visitor_team_score", "home_team_score", 0)
    return games.select("game_id", "game_date", "season", F.inline(F.array(home, away)))


def one_side(games: DataFrame, is_home: int) -> DataFrame:
    """Only the home rows (1) or only the away rows (0)."""
    return side_split(games).where(F.col("is_home") == is_home)
