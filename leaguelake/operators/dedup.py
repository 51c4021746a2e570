"""One row per key, chosen the same way on every run."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in ``newest_first`` order, and every row whose key is NULL.

    A missing key does not make rows copies of each other; such rows also share no group, however
    many there are. Spark applies ``row_number() = 1`` before the shuffle as well, so a key with very many copies
    arrives as one row per map task.
    """
    missing = functools.reduce(Column.__or__, [F.col(k).isNull() for k in key])
    own = F.when(missing, F.monotonically_increasing_id())
    ranked = Window.partitionBy(*key, "__own").orderBy(*newest_first)
    rows = df.withColumn("__own", own).withColumn("__rank", F.row_number().over(ranked))
    return rows.where("__rank = 1").drop("__rank", "__own")


def latest_run(df: DataFrame, key: Sequence[str], run: str = "dt") -> DataFrame:
    """The copy from the newest run; equal runs are settled by the remaining columns."""
    rest = [F.col(c).desc() for c in df.columns if c not in (*key, run)]
    return latest(df, key, [F.col(run).desc(), *rest])


def any_copy(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Whichever copy comes first: only for copies that are known to be equal."""
    return df.dropDuplicates(list(key))
