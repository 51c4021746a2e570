"""Adding up long count arrays that tasks fill: of fixed size, in pieces, without their zeros."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from leaguelake.llm.tables import tidy

PIECE = 1 << 16  # entries of one piece
BRANCHES = 16  # partial sums each piece is first gathered into
_ENTRY = np.dtype([("at", "<u2"), ("n", "<i8")])


def _pack(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    out = np.empty(len(at), _ENTRY)
    out["at"], out["n"] = at, counts[at]
    return out.tobytes()


def _add(data: bytes, total: np.ndarray) -> None:
    entries = np.frombuffer(data, _ENTRY)
    total[entries["at"]] += entries["n"]


def summed(docs: DataFrame, fill: Callable[[pa.RecordBatch, np.ndarray], None], entries: int) -> np.ndarray:
    """Sum over all tasks of the int64 array of ``entries`` that ``fill`` counts a batch into.

    A task keeps one array and hands on its pieces. They are added up in two steps, so a group gets
    the pieces of a share of the tasks, then one row per branch. What reaches the driver is at most ten
    bytes an entry, whatever the input.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(entries, np.int64)
        for batch in batches:
            fill(batch, total)
        branch = TaskContext.get().partitionId() % BRANCHES
        for piece in range(0, entries, PIECE):
            part = total[piece : piece + PIECE]
            if part.any():
                columns = [pa.array([piece], pa.int64()), pa.array([branch], pa.int32()), pa.array([_pack(part)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "branch", "counts"])

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PIECE, np.int64)
        for frame in parts:
            for data in frame["counts"]:
                _add(data, total)
        yield pd.DataFrame({"piece": [key[0]], "branch": [0], "counts": [_pack(total)]})

    schema = "piece long, branch int, counts binary"
    once = docs.mapInArrow(tidy(task), schema).groupBy("piece", "branch").applyInPandas(add, schema)
    out = np.zeros(-(-entries // PIECE) * PIECE, np.int64)
    for row in once.groupBy("piece").applyInPandas(add, schema).toLocalIterator():
        _add(row["counts"], out[row["piece"] : row["piece"] + PIECE])
    return out[:entries]
