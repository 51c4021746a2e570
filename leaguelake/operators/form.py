"""What a team brings into a game: everything is computed from earlier games only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions import ratio
from leaguelake.operators.lanes import Lanes, Timeline, enter
from leaguelake.operators.sides import TEAM_GAMES

LAST = 5


def game_number(lanes: Lanes) -> Column:
    return lanes.ordinal()


def rest_days(lanes: Lanes) -> Column:
    """Days since the entity's previous row; NULL for its first."""
    day = F.col(lanes.timeline.day)
    return F.date_diff(day, lanes.previous(day))


def prior_cumulative(
    df: DataFrame, timeline: Timeline, values: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """Add ``game_number``, ``games_played`` and ``{value}_cum`` over all earlier rows."""
    lanes = enter(df, timeline, sums=values, max_rows=max_rows)
    out = lanes.rows.select(
        "*",
        game_number(lanes).alias("game_number"),
        *[lanes.prior_sum(v).alias(f"{v}_cum") for v in values],
    ).withColumn("games_played", F.col("game_number") - 1)
    return lanes.leave(out)


def rolling_prior(
    df: DataFrame,
    timeline: Timeline,
    values: Sequence[str],
    n: int = LAST,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``{value}_last{n}``: the sum over the ``n`` rows before this one."""
    lanes = enter(df, timeline, before=n, max_rows=max_rows)
    sums = [lanes.last_sum(F.col(v), n).alias(f"{v}_last{n}") for v in values]
    return lanes.leave(lanes.rows.select("*", *sums))


def rest(df: DataFrame, timeline: Timeline, max_rows: int | None = None) -> DataFrame:
    """Add ``rest_days``."""
    lanes = enter(df, timeline, before=1, max_rows=max_rows)
    return lanes.leave(lanes.rows.withColumn("rest_days", rest_days(lanes)))


TOTALS = ("points_for", "points_against", "is_win")


def with_form(lanes: Lanes, n: int = LAST, denominator: str = "fixed") -> DataFrame:
    """The rows of ``lanes``, which carry ``TOTALS`` and ``n`` rows before, with all form columns."""
    if denominator not in ("fixed", "actual"):
        raise ValueError("denominator is 'fixed' or 'actual'")
    played = F.col("games_played")
    recent = F.lit(n) if denominator == "fixed" else F.least(played, F.lit(n))
    known = F.col(f"points_for_last{n}").isNotNull()
    summed = lanes.rows.select(
        "*",
        game_number(lanes).alias("game_number"),
        *[lanes.prior_sum(c).alias(f"{c}_cum") for c in TOTALS],
        *[lanes.last_sum(F.col(c), n).alias(f"{c}_last{n}") for c in TOTALS],
        rest_days(lanes).alias("rest_days"),
    ).withColumn("games_played", F.col("game_number") - 1)
    return summed.select(
        "*",
        ratio(F.col("is_win_cum"), played).alias("win_rate"),
        ratio(F.col("points_for_cum"), played).alias("avg_points_for"),
        ratio(F.col("points_against_cum"), played).alias("avg_points_against"),
        F.when(known, ratio(F.col(f"is_win_last{n}"), recent)).alias(f"win_rate_last{n}"),
        ratio(F.col(f"points_for_last{n}"), recent).alias(f"avg_points_last{n}"),
    )


def team_form(
    sides: DataFrame,
    timeline: Timeline = TEAM_GAMES,
    n: int = LAST,
    denominator: str = "fixed",
    max_rows: int | None = None,
) -> DataFrame:
    """Entering-the-game form of both teams of every game, from a single sort of the team rows.

    ``denominator="fixed"`` divides the last-``n`` sums by ``n`` even when fewer games were played;
    ``"actual"`` divides by the number of games there were. Put a season column into the timeline's
    entity to start every season afresh.
    """
    lanes = enter(sides, timeline, sums=TOTALS, before=n, max_rows=max_rows)
    return lanes.leave(with_form(lanes, n, denominator))
