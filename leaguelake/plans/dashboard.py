"""The dashboard's questions, as DataFrames over team_metrics and match predictions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.operators.buckets import (
    bucket_number,
    bucket_start,
    date_histogram,
    histogram,
    ranges,
    split_terms,
    terms,
)

TEAMS = 30


def filtered(
    df: DataFrame,
    seasons: list[int] | None = None,
    teams: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The dashboard's filter controls; dates include both ends.

    On rows with two teams a match counts for a team whether it played at home or away.
    """
    if seasons is not None:
        df = df.where(F.col("season").isin(seasons))
    if teams is not None:
        names = [c for c in ("team_name", "home_team_name", "away_team_name") if c in df.columns]
        df = df.where(functools.reduce(Column.__or__, [F.col(c).isin(teams) for c in names]))
    if start is not None:
        df = df.where(F.col("game_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("game_date") <= F.lit(end).cast("date"))
    return df


def last_days(df: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Rows of the ``days`` before ``as_of``, and of that day."""
    at = F.lit(as_of).cast("date")
    return df.where(F.col("game_date").between(F.date_sub(at, days), at))


def _average(column: str) -> Column:
    return F.round(F.avg(column), 6)


def win_rate_by_team(team: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(team, "team_name", {"win_rate": _average("win_rate_last5")}, size, "win_rate")


def avg_points_by_team(team: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(team, "team_name", {"avg_points": _average("avg_points_last5")}, size, "avg_points")


def home_away_games(team: DataFrame) -> DataFrame:
    return terms(team, "is_home", {"games": F.count(F.lit(1))}, 2, "games")


def home_away_wins(team: DataFrame) -> DataFrame:
    return terms(team, "is_home", {"wins": F.sum("is_win")}, 2, "wins")


def win_rate_by_conference(team: DataFrame, size: int = 2) -> DataFrame:
    return terms(team, "conference", {"win_rate": _average("win_rate_last5")}, size, "win_rate")


def win_rate_by_rest_days(team: DataFrame, size: int = 10) -> DataFrame:
    return terms(team, "rest_days", {"win_rate": _average("win_rate_last5")}, size)


def _ranking_metrics() -> dict[str, Column]:
    """``home_away_diff`` is the win rate at home minus the win rate away."""
    at_home = F.avg(F.when(F.col("is_home") == 1, F.col("is_win")))
    away = F.avg(F.when(F.col("is_home") == 0, F.col("is_win")))
    return {
        "win_rate": _average("win_rate_last5"),
        "avg_points": _average("avg_points_last5"),
        "home_away_diff": F.round(at_home - away, 6),
        "avg_rest_days": _average("rest_days"),
    }


def team_ranking(team: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(team, "team_name", _ranking_metrics(), size, "win_rate")


def team_ranking_by_conference(team: DataFrame, size: int = TEAMS) -> DataFrame:
    return split_terms(team, "conference", "team_name", _ranking_metrics(), size, "win_rate")


def schedule_by_team(team: DataFrame, size: int = TEAMS) -> DataFrame:
    metrics = {"schedule_difficulty": _average("schedule_difficulty_next5")}
    return terms(team, "team_name", metrics, size, "schedule_difficulty")


def sos_table(team: DataFrame, size: int = TEAMS) -> DataFrame:
    metrics = {
        "schedule_difficulty": _average("schedule_difficulty_next5"),
        "home_games": _average("home_games_next5"),
        "away_games": _average("away_games_next5"),
    }
    return terms(team, "team_name", metrics, size, "schedule_difficulty")


def next5_home_away(team: DataFrame) -> DataFrame:
    """Coming home and away games, added up over all rows."""
    sums = team.agg(
        F.sum("home_games_next5").alias("home"), F.sum("away_games_next5").alias("away")
    )
    return sums.unpivot([], ["home", "away"], "side", "games")


def probability_histogram(scored: DataFrame, interval: float = 0.1) -> DataFrame:
    counts = histogram(
        scored, "win_probability_home", interval, {"matches": F.count(F.lit(1))}, (0.0, 1.0)
    )
    return counts.na.fill(0, ["matches"])


def prediction_accuracy(scored: DataFrame) -> DataFrame:
    """Share of right calls: with 0.5 counted as calling an away win, and with 0.5 never right."""
    won, p = F.col("home_win"), F.col("win_probability_home")
    agrees = (won > 0.5) == (p > 0.5)
    strict = ((won == 1) & (p > 0.5)) | ((won == 0) & (p < 0.5))
    return scored.agg(
        F.round(F.avg(F.when(agrees, 1.0).otherwise(0.0)), 6).alias("accuracy"),
        F.round(F.avg(F.when(strict, 1.0).otherwise(0.0)), 6).alias("accuracy_strict"),
    )


def home_win_rate_by_month(matches: DataFrame) -> DataFrame:
    return date_histogram(matches, "game_date", "month", {"home_win_rate": _average("home_win")})


def score_difference_histogram(matches: DataFrame, width: int = 5) -> DataFrame:
    diff = matches.withColumn(
        "difference", F.col("home_team_score") - F.col("visitor_team_score")
    )
    return histogram(diff, "difference", width, {"matches": F.count(F.lit(1))})


def form_vs_result(matches: DataFrame, interval: float = 0.2) -> DataFrame:
    """Games by recent home form and by result, plus the share won at that form."""
    known = matches.where(F.col("home_win_rate_last5").isNotNull())
    start = bucket_start(bucket_number(F.col("home_win_rate_last5"), interval), interval)
    return known.groupBy(start.alias("form"), "home_win").agg(F.count(F.lit(1)).alias("matches"))


CALIBRATION_EDGES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)


def calibration(scored: DataFrame) -> DataFrame:
    """Share of home wins by range of the predicted probability."""
    metrics = {"matches": F.count(F.lit(1)), "home_win_rate": _average("home_win")}
    found = ranges(scored, "win_probability_home", CALIBRATION_EDGES, metrics)
    return found.na.fill(0, ["matches"])


def confidence(scored: DataFrame) -> DataFrame:
    distance = F.abs(F.col("win_probability_home") - 0.5) * 2
    return scored.agg(F.round(F.avg(distance), 6).alias("confidence"))


def baseline_home(matches: DataFrame) -> DataFrame:
    """Accuracy of always calling a home win."""
    return matches.agg(F.round(F.avg("home_win"), 6).alias("baseline"))


def peek_latest(matches: DataFrame, n: int = 10) -> DataFrame:
    return matches.orderBy(F.col("game_date").desc(), F.col("game_id").desc()).limit(n)
