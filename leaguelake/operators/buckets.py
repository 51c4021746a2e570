"""Bucket aggregations of a dashboard: terms, histogram, ranges and calendar buckets.

Rows without the bucket field are in no bucket, and averages skip missing values. Every grouping
is pre-aggregated before its shuffle, so a bucket holding most of the rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.scale import stored

Metrics = Mapping[str, Column]


def _named(metrics: Metrics) -> list[Column]:
    return [column.alias(name) for name, column in metrics.items()]


def terms(
    df: DataFrame,
    field: str,
    metrics: Metrics,
    size: int,
    order_by: str | None = None,
) -> DataFrame:
    """The top ``size`` values of ``field``: by a metric, highest first, or by key if none is given."""
    grouped = df.where(F.col(field).isNotNull()).groupBy(field).agg(*_named(metrics))
    order = [F.col(field)]
    if order_by:
        order = [F.col(order_by).desc_nulls_last(), F.col(field)]
    return grouped.orderBy(*order).limit(size)


def split_terms(
    df: DataFrame, split: str, field: str, metrics: Metrics, size: int, order_by: str
) -> DataFrame:
    """``terms`` within every value of ``split``."""
    present = df.where(F.col(split).isNotNull() & F.col(field).isNotNull())
    best = Window.partitionBy(split).orderBy(F.col(order_by).desc_nulls_last(), field)
    return (
        present.groupBy(split, field)
        .agg(*_named(metrics))
        .withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= size)
    )


EXACT = "decimal(38,12)"
MOST_BUCKETS = 65_536


def _step(interval: float) -> Decimal:
    step = Decimal(str(interval))
    if step <= 0 or -step.as_tuple().exponent > 12:
        raise ValueError("an interval is positive and has at most 12 decimals")
    return step


def bucket_number(value: Column, interval: float) -> Column:
    """Number of the interval ``value`` falls in, in decimals: 0.3 begins its interval at 0.1 or 0.3.

    Values are taken to 12 decimals, so the error of a sum or quotient does not move one from an edge.
    """
    exact, step = value.try_cast(EXACT), F.lit(_step(interval)).cast(EXACT)
    whole = F.call_function("div", exact, step)  # towards zero
    return whole - F.when((exact < 0) & (whole * step != exact), 1).otherwise(0)


def bucket_start(number: Column, interval: float) -> Column:
    return (number * F.lit(_step(interval))).cast("double")


def histogram(
    df: DataFrame,
    value: str,
    interval: float,
    metrics: Metrics,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Intervals of equal width keyed by their lower end.

    With ``bounds`` the empty intervals between the outermost buckets, widened to the bounds, appear
    too, with NULL metrics; without, only those that hold rows. More than ``MOST_BUCKETS`` intervals
    to fill in are refused: an outlier would ask for any number of empty ones.
    """
    counts = (
        df.select("*", bucket_number(F.col(value), interval).alias("__bucket"))
        .where("__bucket IS NOT NULL")
        .groupBy("__bucket")
        .agg(*_named(metrics))
    )
    if bounds:
        counts = stored(counts, "buckets")
        low, high = (int(Decimal(str(b)) // _step(interval)) for b in bounds)
        first, last = counts.agg(F.min("__bucket"), F.max("__bucket")).first()
        low, high = min(low, low if first is None else first), max(high, high if last is None else last)
        if high - low >= MOST_BUCKETS:
            raise ValueError(f"{high - low + 1} buckets of {interval}: choose a wider interval")
        every = df.sparkSession.range(low, high + 1).withColumnRenamed("id", "__bucket")
        counts = every.join(counts, "__bucket", "left")
    return counts.select(bucket_start(F.col("__bucket"), interval).alias("bucket"), *metrics)


def ranges(df: DataFrame, value: str, edges: Sequence[float], metrics: Metrics) -> DataFrame:
    """Half-open ranges between ``edges``; the last one includes its upper end."""
    pairs = [(float(a), float(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    col = F.col(value)
    start = F.lit(None).cast("double")
    for low, high in reversed(pairs):
        inside = (col >= low) & ((col <= high) if high == float(edges[-1]) else (col < high))
        start = F.when(inside, F.lit(low)).otherwise(start)
    found = df.select("*", start.alias("range_from")).where("range_from is not null")
    counted = found.groupBy("range_from").agg(*_named(metrics))
    rows = [F.struct(F.lit(a).alias("range_from"), F.lit(b).alias("range_to")) for a, b in pairs]
    every = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return every.join(counted, "range_from", "left").select("range_from", "range_to", *metrics)


def date_histogram(df: DataFrame, field: str, unit: str, metrics: Metrics) -> DataFrame:
    """Calendar buckets (``"month"``, ``"week"``, ...) keyed by their first day."""
    first_day = F.date_trunc(unit, F.col(field)).cast("date")
    return (
        df.where(F.col(field).isNotNull())
        .groupBy(first_day.alias(unit))
        .agg(*_named(metrics))
        .orderBy(unit)
    )
