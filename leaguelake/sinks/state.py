"""The one-row load state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.scale import stored


def write_state(mark: DataFrame, path: str, loaded_at: str) -> None:
    """Replace the state with a new mark; an empty mark (nothing loaded) leaves it unchanged."""
    mark = stored(mark.withColumn("last_run", F.lit(loaded_at)), "mark")
    if not mark.isEmpty():
        mark.coalesce(1).write.mode("overwrite").json(path)
