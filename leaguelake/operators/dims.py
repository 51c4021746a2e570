"""Team dimension: two sources that share only a differently spelled name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leaguelake.scale import stored


def team_dim(teams: DataFrame, venues: DataFrame) -> DataFrame:
    """Teams with the venue found under the same normalised name; every team is kept.

    Both inputs must be unique on their keys (``dedup.latest_run``), or teams would multiply.
    """
    return teams.join(venues, "team_name_norm", "left")


def with_team(rows: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``columns`` of the dimension to rows with a ``team_id``; rows without a match stay."""
    return rows.join(stored(dim.select("team_id", *columns), "dim"), "team_id", "left")
