"""The dashboard's team panels from a stored cube of mergeable states.

A cell holds, for one day or one whole month and one season, team, conference, side and number of rest
days, how many rows there are and of every measure the sum and the number of known values. Sums are
decimals, so cells add up to the same whatever their order: cells of several runs are merged by adding,
and a run that corrects rows brings cells of the old rows with the opposite sign. Panels add cells up and
divide last. A range of dates is answered by the cells of its whole months and the days left at its ends.

Defined cases: rows without a day have cells of their own, which no range of dates takes; NULL in
another column is a value like any other and is left out by the panel that groups by it; measures take
12 decimals, and one beyond 10^16 is an error rather than a wrong sum; an empty table has no cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.layout import RUN
from leaguelake.operators.buckets import split_terms, terms
from leaguelake.plans.dashboard import TEAMS
from leaguelake.sources import lake

MEASURES = (
    "is_win",
    "win_rate_last5",
    "avg_points_last5",
    "rest_days",
    "schedule_difficulty_next5",
    "home_games_next5",
    "away_games_next5",
)
DIMS = ("season", "team_name", "conference", "is_home", "rest_days")
PERIODS = ("level", "month", "game_date")
DAY, MONTH = "day", "month"
_WEIGHT = "__weight"
_VALUE = "decimal(28,12)"  # its sums are decimal(38,12)


def _sum(measure: str) -> str:
    return f"{measure}__sum"


def _known(measure: str) -> str:
    return f"{measure}__known"


STATES = ("rows", *[name(m) for m in MEASURES for name in (_sum, _known)])


def cells(rows: DataFrame) -> DataFrame:
    """The cells of team rows, by day and by month, from one shuffle."""
    return _cells(rows.withColumn(_WEIGHT, F.lit(1)))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cells to add to a cube that holds the rows ``before`` so that it holds ``after`` in their place."""
    columns = ["game_date", *DIMS, *[m for m in MEASURES if m not in DIMS]]
    old = before.select(*columns, F.lit(-1).alias(_WEIGHT))
    return _cells(old.unionByName(after.select(*columns, F.lit(1).alias(_WEIGHT))))


def _cells(rows: DataFrame) -> DataFrame:
    # a measure may be a dimension as well (rest days): grouping by it would hide its values
    values = {f"__{m}": F.col(m).cast(_VALUE) for m in MEASURES}
    month = F.trunc("game_date", "month")
    wide = rows.withColumns(values | {"month": month}).select("month", "game_date", *DIMS, _WEIGHT, *values)
    states = [F.sum(_WEIGHT).cast("long").alias("rows")]
    for m in MEASURES:
        value = F.col(f"__{m}")
        states.append(F.sum((value * F.col(_WEIGHT)).cast(_VALUE)).cast("decimal(38,12)").alias(_sum(m)))
        states.append(F.sum(F.when(value.isNotNull(), F.col(_WEIGHT)).otherwise(0)).cast("long").alias(_known(m)))
    keys = [F.col(c) for c in ("month", *DIMS)]
    day = F.col("game_date")
    grouped = wide.groupingSets([[*keys, day], keys], *keys, day)
    level = F.when(F.grouping("game_date") == 1, MONTH).otherwise(DAY).alias("level")
    made = grouped.agg(level, *states)
    return made.where(_not_zero()).select(*PERIODS, *DIMS, *STATES)


def _not_zero() -> Column:
    used = F.col("rows") != 0
    for state in STATES[1:]:
        used |= F.coalesce(F.col(state), F.lit(0)) != 0
    return used


def write_cells(made: DataFrame, table: str, run_date: str) -> None:
    """Put the cells of a run in place of those it had: a repeated run is not added twice."""
    lake.write_run(made.sortWithinPartitions(*PERIODS), table, run_date)


def read_cells(spark: SparkSession, table: str, upto: str | None = None) -> DataFrame:
    """The cells of all runs, or of those up to a run date, not yet added up."""
    runs = lake.read_runs(spark, table)
    if upto is not None:
        runs = runs.where(F.col(RUN) <= F.lit(upto).cast("date"))
    return runs.drop(RUN)


def merged(made: DataFrame) -> DataFrame:
    """One row per cell; cells whose rows were all taken back are gone."""
    added = [F.sum(s).cast("long" if s == "rows" or s.endswith("__known") else "decimal(38,12)").alias(s) for s in STATES]
    return made.groupBy(*PERIODS, *DIMS).agg(*added).where(_not_zero())


def pick(
    made: DataFrame,
    seasons: list[int] | None = None,
    teams: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The cells that together hold the rows the dashboard's filters leave; dates include both ends."""
    first, last = (None if d is None else F.lit(d).cast("date") for d in (start, end))
    month = F.col("month")
    whole = F.lit(True)
    inside = F.lit(True)
    if first is not None:
        whole, inside = whole & (month >= first), inside & (F.col("game_date") >= first)
    if last is not None:
        whole, inside = whole & (F.last_day(month) <= last), inside & (F.col("game_date") <= last)
    level = F.col("level")
    if first is None and last is None:
        made = made.where(level == MONTH)
    else:
        made = made.where(((level == MONTH) & whole) | ((level == DAY) & inside & ~whole))
    if seasons is not None:
        made = made.where(F.col("season").isin(seasons))
    if teams is not None:
        made = made.where(F.col("team_name").isin(teams))
    return made


def _mean(measure: str, of: Column | None = None) -> Column:
    """Average over all rows of the cells, or of those where ``of`` holds; NULL without known values."""
    total, known = F.col(_sum(measure)), F.col(_known(measure))
    if of is not None:
        total, known = F.when(of, total), F.when(of, known)
    n = F.sum(known)
    return F.when(n != 0, F.sum(total).cast("double") / n)


def _average(measure: str) -> Column:
    return F.round(_mean(measure), 6)


def _ranking() -> dict[str, Column]:
    at_home = _mean("is_win", F.col("is_home") == 1)
    away = _mean("is_win", F.col("is_home") == 0)
    return {
        "win_rate": _average("win_rate_last5"),
        "avg_points": _average("avg_points_last5"),
        "home_away_diff": F.round(at_home - away, 6),
        "avg_rest_days": _average("rest_days"),
    }


def win_rate_by_team(c: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(c, "team_name", {"win_rate": _average("win_rate_last5")}, size, "win_rate")


def avg_points_by_team(c: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(c, "team_name", {"avg_points": _average("avg_points_last5")}, size, "avg_points")


def home_away_games(c: DataFrame) -> DataFrame:
    return terms(c, "is_home", {"games": F.sum("rows")}, 2, "games")


def home_away_wins(c: DataFrame) -> DataFrame:
    return terms(c, "is_home", {"wins": F.sum(_sum("is_win")).cast("long")}, 2, "wins")


def win_rate_by_conference(c: DataFrame, size: int = 2) -> DataFrame:
    return terms(c, "conference", {"win_rate": _average("win_rate_last5")}, size, "win_rate")


def win_rate_by_rest_days(c: DataFrame, size: int = 10) -> DataFrame:
    return terms(c, "rest_days", {"win_rate": _average("win_rate_last5")}, size)


def team_ranking(c: DataFrame, size: int = TEAMS) -> DataFrame:
    return terms(c, "team_name", _ranking(), size, "win_rate")


def team_ranking_by_conference(c: DataFrame, size: int = TEAMS) -> DataFrame:
    return split_terms(c, "conference", "team_name", _ranking(), size, "win_rate")


def schedule_by_team(c: DataFrame, size: int = TEAMS) -> DataFrame:
    metrics = {"schedule_difficulty": _average("schedule_difficulty_next5")}
    return terms(c, "team_name", metrics, size, "schedule_difficulty")


def sos_table(c: DataFrame, size: int = TEAMS) -> DataFrame:
    metrics = {
        "schedule_difficulty": _average("schedule_difficulty_next5"),
        "home_games": _average("home_games_next5"),
        "away_games": _average("away_games_next5"),
    }
    return terms(c, "team_name", metrics, size, "schedule_difficulty")


def next5_home_away(c: DataFrame) -> DataFrame:
    sums = c.agg(*[F.sum(_sum(f"{side}_games_next5")).cast("double").alias(side) for side in ("home", "away")])
    return sums.unpivot([], ["home", "away"], "side", "games")


#: the panels by the name of the question they answer in ``dashboard``
PANELS: dict[str, Callable[[DataFrame], DataFrame]] = {
    panel.__name__: panel
    for panel in (
        win_rate_by_team,
        avg_points_by_team,
        home_away_games,
        home_away_wins,
        win_rate_by_conference,
        win_rate_by_rest_days,
        team_ranking,
        team_ranking_by_conference,
        schedule_by_team,
        sos_table,
        next5_home_away,
    )
}
