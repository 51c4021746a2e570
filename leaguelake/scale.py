"""Shared scratch storage, and tables whose real size Spark knows before it plans a join."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
ALLOW_TMP = "leaguelake.scratch.allowTmp"
TASK_ROWS = "leaguelake.window.taskRows"
DEFAULT_TASK_ROWS = 4_000_000


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local master may fall back to a temporary one."""
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if shared:
        if not local and is_temporary(shared) and spark.conf.get(ALLOW_TMP, "false") != "true":
            raise ValueError(f"{shared} is every machine's own: {CHECKPOINT_DIR} must be shared")
        return shared.rstrip("/")
    if not local:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _local_root()


def is_temporary(path: str) -> bool:
    """Whether a path lies in a folder that is usually local to a machine."""
    plain = path.removeprefix("file://").removeprefix("file:")
    return plain.startswith(("/tmp/", "/var/tmp/", "/dev/shm/")) or plain in ("/tmp", "/var/tmp")


@functools.cache
def _local_root() -> str:
    local = tempfile.mkdtemp(prefix="leaguelake-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return local


_SCOPES: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to."""
    folder = _SCOPES[-1] if _SCOPES else f"{scratch_root(spark)}/leaguelake"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """Tables stored inside are deleted at the end: nothing lazy may leave the block."""
    folder = scratch_path(spark, label)
    _SCOPES.append(folder)
    try:
        yield
    finally:
        _SCOPES.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The result survives lost executors, is computed once however often it is used, and has a file
    size Spark sees at planning time: a join broadcasts it below ``autoBroadcastJoinThreshold`` and
    shuffles it above, so no broadcast hint is needed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # small row groups: a task holds one in memory while it writes
    df.write.option("parquet.block.size", str(16 << 20)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILE, AT = "__file", "__at"


def placed(df: DataFrame, label: str) -> DataFrame:
    """``df``, a scan of Parquet files, with each row's file and number in it; another ``df`` is stored first.

    Rows keep their place however a scan is cut into tasks, so they can be found again by it.
    """
    place = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT)]
    try:
        return df.select("*", *place)
    except AnalysisException:
        return stored(df, label).select("*", *place)


def task_rows(spark: SparkSession) -> int:
    """Rows of one group a single window task may be given before the group is split."""
    return int(spark.conf.get(TASK_ROWS, str(DEFAULT_TASK_ROWS)))
