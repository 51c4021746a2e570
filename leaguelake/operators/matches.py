"""One row per game with both teams side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions import beats
from leaguelake.scale import stored

# Fixed names: team column -> suffix after home_ / away_ in the match row.
PAIRED = {
    "win_rate": "win_rate",
    "avg_points_for": "avg_points",
    "avg_points_against": "avg_points_against",
    "win_rate_last5": "win_rate_last5",
    "avg_points_last5": "avg_points_last5",
    "rest_days": "rest_days",
    "schedule_difficulty_next5": "schedule_difficulty",
    "home_games_next5": "home_games_next5",
    "away_games_next5": "away_games_next5",
}


def match_rows(team_rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Fold the two team rows of each game into one.

    One shuffle by game id and fixed-width values only; the names are looked up afterwards. Joining
    the games to their home rows and then to their away rows would evaluate the team windows twice.
    """

    def of(side: int, column: str) -> Column:
        return F.max(F.when(F.col("is_home") == side, F.col(column)))

    def history(side: int, column: str) -> Column:
        known = (F.col("is_home") == side) & F.col("team_id").isNotNull()
        return F.max(F.when(known, F.col(column)))

    # Grouping only halves the rows, so they are shuffled first: adding up before the shuffle would
    # keep a hash entry for nearly every game in each map task and send wider rows.
    folded = team_rows.repartition("game_id").groupBy("game_id").agg(
        F.max("game_date").alias("game_date"),
        F.max("season").alias("season"),
        of(1, "team_id").alias("home_team_id"),
        of(0, "team_id").alias("visitor_team_id"),
        of(1, "points_for").alias("home_team_score"),
        of(0, "points_for").alias("visitor_team_score"),
        *[
            history(side, column).alias(f"{prefix}_{suffix}")
            for prefix, side in (("home", 1), ("away", 0))
            for column, suffix in PAIRED.items()
        ],
    )
    names = stored(dim.select("team_id", "team_name"), "names")
    home = names.toDF("home_team_id", "home_team_name")
    away = names.toDF("visitor_team_id", "away_team_name")
    return (
        folded.join(home, "home_team_id", "left")
        .join(away, "visitor_team_id", "left")
        .select(
            "game_id",
            "game_date",
            "season",
            "home_team_id",
            "visitor_team_id",
            "home_team_score",
            "visitor_team_score",
            beats(F.col("home_team_score"), F.col("visitor_team_score")).alias("home_win"),
            "home_team_name",
            *[f"home_{suffix}" for suffix in PAIRED.values()],
            "away_team_name",
            *[f"away_{suffix}" for suffix in PAIRED.values()],
        )
    )
