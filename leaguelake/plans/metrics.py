"""The combined layer: team_metrics and match_metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.operators.dims import with_team
from leaguelake.operators.form import LAST, TOTALS, team_form, with_form
from leaguelake.operators.lanes import enter
from leaguelake.operators.matches import match_rows
from leaguelake.operators.schedule import (
    HORIZON,
    form_and_strength,
    schedule_constants,
    sos_rank,
    with_simple,
)
from leaguelake.operators.sides import TEAM_GAMES, side_split
from leaguelake.scale import stored

# Fixed column order of the table.
TEAM_METRICS = [
    "game_id",
    "game_date",
    "season",
    "team_id",
    "team_name",
    "conference",
    "division",
    "is_home",
    "points_for",
    "points_against",
    "is_win",
    "win_rate",
    "avg_points_for",
    "avg_points_against",
    "win_rate_last5",
    "avg_points_last5",
    "rest_days",
    "schedule_difficulty_next5",
    "home_games_next5",
    "away_games_next5",
]
# What the look-ahead by strength adds.
STRENGTH_METRICS = ["schedule_difficulty_next10", "b2b_games_next5", "sos_rank"]
_DIM = ["team_name", "conference", "division"]
# Types as in the placeholder columns: runs of one table must agree, however they were computed.
_TYPES = {
    "schedule_difficulty_next5": "float",
    "home_games_next5": "double",
    "away_games_next5": "double",
}


def team_rows(
    games: DataFrame,
    schedule: str = "constant",
    status: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Both teams of every game with form and schedule columns, from one pass over the timelines.

    ``games`` must be unique on ``game_id``: a copy of a game would count as a game played before.
    ``schedule`` is ``"constant"`` (the placeholder values), ``"simple"`` (look-ahead counts) or
    ``"strength"``. ``status`` keeps only games in that state, e.g. ``"final"``.
    """
    if status is not None:
        games = games.where(F.col("status") == status)
    sides = side_split(games)
    if schedule == "constant":
        return schedule_constants(team_form(sides, max_rows=max_rows))
    if schedule == "simple":
        lanes = enter(sides, TEAM_GAMES, TOTALS, LAST, HORIZON, max_rows)
        rows = lanes.leave(with_simple(lanes, with_form(lanes)))
    elif schedule == "strength":
        rows = _with_rank(stored(form_and_strength(sides, max_rows=max_rows), "strength"))
    else:
        raise ValueError("schedule is 'constant', 'simple' or 'strength'")
    return rows.withColumns({c: F.col(c).cast(kind) for c, kind in _TYPES.items()})


def _with_rank(rows: DataFrame) -> DataFrame:
    """Add the team's place by the difficulty ahead of it, the same on all its rows."""
    # Rounded before ranking: averages differing in the last bit would rank equal teams apart.
    value = F.round("schedule_difficulty_next5", 6).alias("schedule_difficulty_next5")
    ranks = sos_rank(rows.select("team_id", "game_id", "game_date", value))
    return rows.join(stored(ranks.select("team_id", "sos_rank"), "sos"), "team_id", "left")


def team_metrics(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per game and team; rows with strength of schedule keep its further columns."""
    more = [c for c in STRENGTH_METRICS if c in rows.columns]
    return with_team(rows, dim, _DIM).select(*TEAM_METRICS, *more)


def match_metrics(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per game."""
    return match_rows(rows, dim)
