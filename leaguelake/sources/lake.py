"""Parquet tables partitioned by run date."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.layout import RUN


def read_runs(spark: SparkSession, table: str) -> DataFrame:
    """All runs of a table, with the run date as a column."""
    return spark.read.parquet(table)


def read_run(spark: SparkSession, table: str, run_date: str) -> DataFrame:
    """One run of a table; only its directory is listed in the scan."""
    return read_runs(spark, table).where(F.col(RUN) == F.lit(run_date).cast("date")).drop(RUN)


def read_latest_run(spark: SparkSession, table: str, run_date: str | None = None) -> DataFrame:
    """The newest run, up to ``run_date`` if given, for dimensions a load did not bring again.

    Runs are told from the listed file names; no file is opened.
    """
    runs = read_runs(spark, table)
    days = {m[1] for f in runs.inputFiles() if (m := re.search(rf"/{RUN}=(\d{{4}}-\d\d-\d\d)/", f))}
    known = [day for day in days if run_date is None or day <= run_date]
    if not known:
        raise RuntimeError(f"no run of {table} up to {run_date}")
    return runs.where(F.col(RUN) == F.lit(max(known)).cast("date")).drop(RUN)


def write_run(df: DataFrame, table: str, run_date: str) -> None:
    """Replace one run of a table and leave the others alone, so a rerun changes nothing.

    The run's directory is overwritten as such: an empty result replaces earlier rows as well.
    """
    df.write.mode("overwrite").parquet(f"{table}/{RUN}={run_date}")


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
