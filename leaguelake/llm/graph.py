"""Connected components of a stored table of links, and joins whose small side is counted first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.scale import stored

BROADCAST_BYTES = 32 << 20


def small(frame: DataFrame, width: int = 32) -> DataFrame:
    """A stored table with rows of at most ``width`` bytes, to be broadcast if it is small enough, and else
    joined by a shuffle."""
    return F.broadcast(frame) if frame.count() * width <= BROADCAST_BYTES else frame


def components(links: DataFrame) -> DataFrame:
    """``row`` and ``root``, the smallest row its links lead to, for rows with a link.

    ``links`` has columns a and b. Large-star and small-star steps in turn: every row tells its larger,
    then its smaller neighbours of the smallest one it sees, until all are stars. Only minima and
    pairs travel, never the neighbours of a row together.
    """
    pairs = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "link-minima")
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(larger.where("u <> v").distinct(), "links")
        least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "link-minima")
        told = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        pairs = stored(told.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # stars: nobody points at a row that itself points on; then nothing changes any more
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = pairs.select(F.col("u").alias("row"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
