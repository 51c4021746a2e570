"""Source filters, the incremental slice and its high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.functions import iso_date
from leaguelake.schemas import STATE
from leaguelake.sources.lake import if_present


def in_seasons(games: DataFrame, first: int, last: int) -> DataFrame:
    return games.where(F.col("season").isin(list(range(first, last + 1))))


def in_dates(
    df: DataFrame, start: str | None = None, end: str | None = None, day: str = "game_date"
) -> DataFrame:
    """Rows dated ``start`` to ``end``, both included; either may be left open."""
    if start is not None:
        df = df.where(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(day) <= F.lit(end).cast("date"))
    return df


def read_state(spark: SparkSession, path: str) -> str | None:
    """``last_date`` of the stored one-row state, or None before the first load."""
    state = if_present(lambda: spark.read.schema(STATE).json(path))
    if state is None:
        return None
    # a mark that is no date is no mark
    rows = state.select(F.col("last_date").try_cast("date").cast("string")).take(1)
    return rows[0][0] if rows else None


def incremental_slice(df: DataFrame, last_date: str | None, day: str = "game_date") -> DataFrame:
    """Rows after the last loaded day; everything when nothing was loaded before."""
    if last_date is None:
        return df
    return df.where(F.col(day) > F.lit(last_date).cast("date"))


def high_water_mark(raw: DataFrame) -> DataFrame:
    """Newest day and number of records of a raw slice; no row where there is no readable day."""
    return loaded_mark(raw.select(iso_date(F.col("date")).alias("game_date")))


def loaded_mark(games: DataFrame) -> DataFrame:
    """Newest day and number of the games a load really brought."""
    return games.agg(
        F.max("game_date").cast("string").alias("last_date"),
        F.count(F.lit(1)).alias("last_game_count"),
    ).where(F.col("last_date").isNotNull())


def guard_nonempty(df: DataFrame, what: str, incremental: bool = False) -> DataFrame:
    """Stop a full load that brought nothing; an incremental one may be empty."""
    if not incremental and df.isEmpty():
        raise RuntimeError(f"no {what} in a full load")
    return df
