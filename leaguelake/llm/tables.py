"""The tables the queries of this folder read, and intermediate tables that go when they have served."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leaguelake.scale import scratch, scratch_path

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers look for this package where the driver has it, if it is not installed there
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; all else that it stores on the way is deleted."""
    path = scratch_path(spark, label)
    with scratch(spark, label):
        made = build()
        schema = made.schema
        made.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def tidy(task: Callable) -> Callable:
    """The same Arrow task, after which a worker returns freed memory to the system: workers live on
    and serve later stages, beside others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return run


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send workers at most ``rows`` rows together: whole texts make large batches, which
    the executor holds outside its heap and the worker once more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Shelf:
    """Tables in the shared folder, by name: putting a name again deletes what it stood for before.

    What a returned DataFrame still reads must be kept (``keep``), all else goes with ``clear``.
    """

    def __init__(self, spark: SparkSession, label: str):
        self._spark, self._label = spark, label
        self._paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame, codec: str = "zstd") -> DataFrame:
        path = scratch_path(self._spark, f"{self._label}-{name}")
        # small row groups: a task holds one in memory while it writes
        df.write.option("compression", codec).option("parquet.block.size", str(16 << 20)).parquet(path)
        self.drop(name)
        self._paths[name] = path
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self._paths.pop(name, None)
            if path:
                folder = self._spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)

    def keep(self, *names: str) -> None:
        for name in names:
            self._paths.pop(name, None)

    def clear(self) -> None:
        self.drop(*list(self._paths))
