"""Load only files that were not loaded before.

The stream's checkpoint remembers the files, so no date has to be kept; a game that comes again with
a later run replaces the earlier copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.layout import RUN
from leaguelake.operators.dedup import latest, latest_run
from leaguelake.schemas import RAW_GAME
from leaguelake.sinks.parts import PartTable
from leaguelake.sources.raw import (
    FILE,
    GAMES_WRAPPER,
    RAW_TEXT,
    REASON,
    format_games,
    quarantined,
    unwrap_checked,
)

LOAD = "load"


def current_table(path: str, buckets: int = 64) -> PartTable:
    """The table of one copy of each game that ``load_new_games`` keeps up to date."""
    return PartTable(path, ("game_id",), buckets)


def load_new_games(
    spark: SparkSession,
    raw_root: str,
    table: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    multi_line: bool = False,
    quarantine: str | None = None,
    current: PartTable | None = None,
) -> None:
    """Append the games of all new files below ``raw_root/dt=...`` to ``table`` and stop.

    With ``current``, every batch also brings that table of one copy of each game up to date, of which
    it rewrites the parts its games fall in. What cannot be read as a game goes to ``quarantine`` (by default ``table`` with a suffix).

    Every micro-batch owns the directory ``load=<batch id>`` and overwrites only that one: a batch
    that is repeated after a failure leaves the same rows.
    """
    files = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(raw_root, wholetext=multi_line)
        .withColumn(FILE, F.col("_metadata.file_path"))
    )
    aside = quarantine or f"{table.rstrip('/')}-quarantine"

    def write(batch: DataFrame, batch_id: int) -> None:
        quarantined(batch).write.mode("overwrite").parquet(f"{aside}/{LOAD}={batch_id}")
        good = format_games(batch.where(F.col(REASON).isNull())).drop(REASON, RAW_TEXT, FILE)
        games = latest_run(good, ["game_id"], RUN)
        games.write.mode("overwrite").parquet(f"{table}/{LOAD}={batch_id}")
        if current is not None:
            loaded = spark.read.schema(games.schema).parquet(f"{table}/{LOAD}={batch_id}")
            marked = loaded.withColumn(LOAD, F.lit(batch_id).cast("long"))
            current.upsert(marked, _newest(), batch_id)

    query = (
        unwrap_checked(files, RAW_GAME, "id", GAMES_WRAPPER)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _newest() -> list[Column]:
    return [F.col(RUN).desc(), F.col(LOAD).desc()]


def current_games(spark: SparkSession, table: str | PartTable) -> DataFrame:
    """The newest copy of every game loaded so far.

    A ``PartTable`` is read as it is; the path of the loads is ranked, over all loads there were.
    """
    if isinstance(table, PartTable):
        games = table.read(spark)
        if games is None:
            raise RuntimeError(f"no game was loaded into {table.path}")
        return games.drop(RUN, LOAD)
    return latest(spark.read.parquet(table), ["game_id"], _newest()).drop(RUN, LOAD)
