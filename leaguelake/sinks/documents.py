"""Rows as JSON documents, written by the executors."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.operators.ranking import number_rows

BATCH_SIZE = 500
ASCII = {"writeNonAsciiCharacterAsCodePoint": "true"}


def document(df: DataFrame, keep_nulls: Sequence[str] = ()) -> Column:
    """The row as JSON without its NULL fields, except ``keep_nulls``, which stay as null."""
    rest = F.to_json(F.struct(*[c for c in df.columns if c not in keep_nulls]), ASCII)
    if not keep_nulls:
        return rest
    kept = F.to_json(F.struct(*keep_nulls), {**ASCII, "ignoreNullFields": "false"})
    joined = F.concat(F.regexp_replace(rest, r"\}$", ","), F.substr(kept, F.lit(2)))
    return F.when(rest == "{}", kept).otherwise(joined)


def bulk_lines(df: DataFrame, index: str, keep_nulls: Sequence[str] = ()) -> DataFrame:
    """One row per document: action line, line break, document."""
    return df.select(F.concat(F.lit(_action(index)), document(df, keep_nulls)).alias("value"))


def _action(index: str) -> str:
    return json.dumps({"index": {"_index": index}}) + "\n"


def write_bulk(
    df: DataFrame,
    path: str,
    index: str,
    keep_nulls: Sequence[str] = (),
    documents_per_file: int = 0,
) -> None:
    """Replace the export at ``path``. Files are as large as the partitions, or limited if asked for.

    A request of ``BATCH_SIZE`` documents is any ``2 * BATCH_SIZE`` lines of a file in their order, or
    a row of ``bulk_requests``.
    """
    (
        bulk_lines(df, index, keep_nulls)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", documents_per_file)
        .text(path)
    )


def read_bulk(spark: SparkSession, path: str, index: str) -> DataFrame:
    """The documents of an export, one a row: files are split at the action lines, wherever they are cut."""
    pieces = spark.read.option("lineSep", _action(index)).text(path)
    return pieces.select(F.rtrim("value", F.lit("\n")).alias("doc")).where("doc <> ''")


def bulk_requests(spark: SparkSession, path: str, index: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """The bodies to send: one row of at most ``batch_size`` action and document lines each."""
    row = F.monotonically_increasing_id()  # counts from 0 in every partition
    numbered = read_bulk(spark, path, index).withColumn("__row", row)
    part, place = F.shiftright("__row", 33), F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    lines = F.array_sort(F.collect_list(F.struct("__row", "doc")))
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit(_action(index)), x["doc"], F.lit("\n"))), "")
    batch = F.floor(place / batch_size).alias("__batch")
    return (
        numbered.groupBy(part.alias("__part"), batch)
        .agg(body.alias("body"), F.count(F.lit(1)).alias("documents"))
        .select("documents", "body")
    )


def with_batch(
    df: DataFrame,
    day: str = "game_date",
    key: str = "game_id",
    batch_size: int = BATCH_SIZE,
    max_rows: int | None = None,
) -> DataFrame:
    """Add the number of the batch of ``batch_size`` documents a row falls in, in (day, key) order."""
    numbered = number_rows(df, day, [key], "__n", max_rows)
    return numbered.withColumn(
        "batch", F.floor((F.col("__n") - 1) / F.lit(batch_size)).cast("long")
    ).drop("__n")
