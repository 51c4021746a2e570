"""Last value known at a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_last(df: DataFrame, entity: str, day: str, value: str, order: str) -> DataFrame:
    """One row per entity and day: the value of the day's last row that has one."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(entity, day).agg(F.max_by(value, order).alias(value))


def asof_last(
    probes: DataFrame, known: DataFrame, entity: str, day: str, value: str
) -> DataFrame:
    """For every (entity, day) in ``probes`` the last ``known`` value on or before that day.

    ``known`` has one row per entity and day (see ``daily_last``) and the probes are reduced to
    distinct pairs before the shuffle, so an entity brings at most two rows per calendar day into
    its window, however many games it has.
    """
    pairs = probes.select(entity, day).distinct()
    both = known.select(entity, day, value, F.lit(0).alias("__probe")).unionByName(
        pairs.select(entity, day, F.lit(None).cast(known.schema[value].dataType).alias(value),
                     F.lit(1).alias("__probe"))
    )
    upto = (
        Window.partitionBy(entity)
        .orderBy(day, "__probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn(value, F.last(value, ignorenulls=True).over(upto))
        .where("__probe = 1")
        .drop("__probe")
    )
