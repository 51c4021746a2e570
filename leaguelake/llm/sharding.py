"""Contiguous shards of near equal bytes, from prefix sums over per-partition totals. Native.

Documents are ordered by ``doc_id`` (NULL first; ties by size and checksum). Rows that agree in all
three are interchangeable, so a running number may deal them to several partitions and no id is ever
too large for one task. Each range partition is summed where it lies; only one row per partition is
summed globally. A row goes to the shard in whose equal share of the bytes its middle byte falls, so
a shard differs from the mean by at most the size of one document; a document is never cut.

Defined cases: a NULL text has 0 bytes and checksum 0; an empty table gives no rows; other columns
are not carried (join by ``doc_id`` where it is unique). Equal texts form no groups here: ``bytes`` is
the law that holds, and a group of copies as large as a shard could not stay together under it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.scale import stored

ROW_BYTES = 8
ORDER = ("doc_id", "size", "text_crc32", "row")


def shard_by_bytes(docs: DataFrame, shards: int = 24, row_bytes: int = ROW_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in the shard) of every row.

    The ranges of the first shuffle are sampled, so its rows are stored with their partition number
    before anything is summed.
    """
    octets = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sized = docs.select(
        "doc_id",
        (octets + row_bytes).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    dealt = stored(
        sized.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "shard-rows"
    )
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # one row per partition of the shuffle above
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    prefix = stored(
        totals.select(
            "part",
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
        ),
        "shard-totals",
    )
    within = Window.partitionBy("part").orderBy(*ORDER)
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    running = dealt.select(
        "*", before.alias("local_bytes"), (F.row_number().over(within) - 1).alias("local_row")
    ).join(prefix, "part")
    # whole numbers: exact up to 2^62 / shards bytes
    shard = F.expr(f"((bytes_before + local_bytes) * 2 + size) * {int(shards)} div (all_bytes * 2)")
    placed = stored(
        running.select(
            "doc_id",
            "size",
            "text_crc32",
            shard.cast("int").alias("shard"),
            (F.col("rows_before") + F.col("local_row")).alias("place"),
        ),
        "shard-places",
    )
    # one row per shard
    starts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
    )


def sharded(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return shard_by_bytes(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
