"""Order over all rows without sending all rows to one task.

Equal values are first added up, then the distinct values are treated as one timeline, which
``lanes`` deals by range once it is too long for a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.operators.lanes import Timeline, enter
from leaguelake.scale import stored

ALL = "__all"


def _along(counts: DataFrame) -> DataFrame:
    """The stored distinct values, all on one timeline."""
    return counts.withColumn(ALL, F.lit(0))


def rank_desc(df: DataFrame, value: str, name: str, max_rows: int | None = None) -> DataFrame:
    """Add ``rank()`` of ``value``, highest first; rows without a value get none.

    ``df`` is read twice, once for the distinct values and once for the result.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy((-F.col(value)).alias("__down"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    counts = _along(stored(counts, "values"))
    lanes = enter(counts, Timeline((ALL,), "__down"), ["__n"], max_rows=max_rows)
    higher = F.coalesce(lanes.prior_sum("__n"), F.lit(0))
    ranked = lanes.rows.withColumn(name, (higher + 1)).where(lanes.is_own)
    ranks = stored(ranked.select((-F.col("__down")).alias("__value"), name), "ranks")
    return df.join(ranks, F.col(value) == F.col("__value"), "left").drop("__value")


def rank_auc(df: DataFrame, score: str, label: str, max_rows: int | None = None) -> DataFrame:
    """Area under the ROC curve: how often a positive row outscores a negative one (ties half)."""
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(score)
        .agg(
            F.sum(F.col(label)).cast("long").alias("__pos"),
            F.sum(1 - F.col(label)).cast("long").alias("__neg"),
        )
    )
    counts = _along(stored(counts, "values"))
    lanes = enter(counts, Timeline((ALL,), score), ["__neg"], max_rows=max_rows)
    below = F.coalesce(lanes.prior_sum("__neg"), F.lit(0))
    placed = lanes.rows.withColumn("__below", below).where(lanes.is_own)
    wins = F.sum(F.col("__pos").cast("double") * (F.col("__below") + F.col("__neg") / 2))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return placed.agg(F.try_divide(wins, pairs).alias("auc"))


def number_rows(
    df: DataFrame, day: str, ties: Sequence[str], name: str, max_rows: int | None = None
) -> DataFrame:
    """Add 1, 2, 3, ... over all rows in (``day``, ``ties``) order."""
    line = Timeline(entity=(ALL,), day=day, ties=tuple(ties))
    lanes = enter(df.withColumn(ALL, F.lit(0)), line, max_rows=max_rows)
    return lanes.leave(lanes.rows.withColumn(name, lanes.ordinal())).drop(ALL)
