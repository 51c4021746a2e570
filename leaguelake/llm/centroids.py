"""Centroid clustering on whole numbers with an incremental distance matrix.

A vector's components become whole numbers, so every dot product and distance is exact. For each vector
the dot products with all centroids are kept with it (``clusters`` numbers a row, in the shared folder).
When the centroids move, a row's products are corrected by the components of each centroid that have
changed, and by no others; the squared distance is |v|^2 - 2 v.c + |c|^2, and the smallest one wins
(ties: the smaller number). A centroid that stays costs nothing, and none is ever multiplied anew.

Tasks add up the vectors of each cluster themselves and hand on one row per cluster and component, so
it does not matter how many rows a cluster holds. The driver keeps the centroids only. A round reads
the rows of the round before, writes them with corrected products, and deletes the older ones.

Defined cases: vectors that are NULL, of another length, or with a NULL, NaN or infinite component are
left out; a NULL vec_id is hashed as empty text; of vectors with one hash the smaller components come
first; repeated rows count each, and equal centroids leave all but the first empty, which then stay; fewer
vectors than ``clusters`` make as many centroids; an empty table gives no rows; other columns are
ignored. Components beyond 2^27 after scaling raise an error, because distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.tables import Shelf
from leaguelake.scale import stored

MOST = 1 << 27  # of a component: 64 squared differences then fit into 62 bits


@dataclass(frozen=True)
class Settings:
    size: int = 64
    scale: int = 256
    clusters: int = 40
    rounds: int = 5
    salt: str = "2:"


def whole_vectors(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id and ``v``, the components as whole numbers, of the rows that have a usable vector."""
    given = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    usable = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("e", lambda x: F.floor(x * s.scale))
    return given.where((F.size("e") == s.size) & usable).select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, s: Settings) -> np.ndarray:
    """The vectors with the smallest hash of their id, in its order."""
    text = F.concat(F.lit(s.salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.select(F.sha2(text, 256).alias("hash"), "v").orderBy("hash", "v").limit(s.clusters).collect()
    return np.array([r["v"] for r in chosen], np.int64).reshape(len(chosen), s.size)


def corrected(v: np.ndarray, dots: np.ndarray, centroids: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dot products after the centroids have changed to ``centroids`` by ``change``; the nearest one of
    each vector and its squared distance."""
    dots = dots.copy()
    for k, moved in enumerate(change):
        at = np.flatnonzero(moved)
        if len(at):
            dots[:, k] += v[:, at] @ moved[at]
    distance = (v * v).sum(1)[:, None] - 2 * dots + (centroids * centroids).sum(1)
    cluster = distance.argmin(1)
    return dots, cluster, distance[np.arange(len(v)), cluster]


def _numbers(column: pa.Array, kind: type, width: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, kind).reshape(-1, width).astype(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    data = np.ascontiguousarray(rows).tobytes()
    return pa.array([data[i : i + width] for i in range(0, len(data), width)], pa.binary())


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = np.array(batch.column("v").flatten(), np.int64).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _binary(v.astype("<i4"))], ["vec_id", "v"])


STATE = "vec_id long, v binary, dots binary, cluster int, distance long"


def assigned(state: DataFrame, centroids: np.ndarray, before: np.ndarray) -> DataFrame:
    """``state`` with its dot products moved on from centroids ``before``, and every row's cluster."""
    k, size = centroids.shape
    change = centroids - before
    fresh = "dots" not in state.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _numbers(batch.column("v"), "<i4", size)
            dots = np.zeros((len(v), k), np.int64) if fresh else _numbers(batch.column("dots"), "<i8", k)
            dots, cluster, distance = corrected(v, dots, centroids, change)
            columns = [batch.column("vec_id"), batch.column("v"), _binary(dots), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "dots", "cluster", "distance"])

    return state.mapInArrow(task, STATE)


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid with vectors becomes their mean, rounded down by component; the others stay."""
    k, size = centroids.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v, cluster = _numbers(batch.column("v"), "<i4", size), batch.column("cluster").to_numpy()
            np.add.at(total, cluster, v)
            n += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(n)
        columns = [np.repeat(some, size), np.tile(np.arange(size), len(some)), total[some].ravel(), np.repeat(n[some], size)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "at", "total", "n"])

    sums = state.select("v", "cluster").mapInArrow(task, "k long, at long, total long, n long")
    out = centroids.copy()
    # one row per centroid and component
    for r in sums.groupBy("k", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r["k"], r["at"]] = r["total"] // r["n"]
    return out


def clustered(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The contract's columns for every usable vector."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, s)
    limits = vectors.select(F.array_min("v").alias("low"), F.array_max("v").alias("high")).agg(F.min("low"), F.max("high")).first()
    if limits[0] is None:
        return spark.createDataFrame([], SCHEMA)
    if max(-limits[0], limits[1]) > MOST:
        raise ValueError(f"components reach from {limits[0]} to {limits[1]}: squared distances do not fit a long")
    centroids = first_centroids(vectors, s)
    before = np.zeros_like(centroids)
    shelf = Shelf(spark, "centroids")
    state = shelf.put("rows", vectors.mapInArrow(_packed, "vec_id long, v binary"))
    for _ in range(s.rounds):
        state = shelf.put("rows", assigned(state, centroids, before))
        before, centroids = centroids, moved(state, centroids)
    final = stored(assigned(state, centroids, before).select("vec_id", "cluster", "distance"), "centroids-result")
    shelf.clear()
    # one row per centroid
    sums = final.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    total = sum(r["inertia"] for r in sums)
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    known = spark.createDataFrame(
        [(r["cluster"], r["inertia"], total, hashes[r["cluster"]]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    order = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return final.join(F.broadcast(known), "cluster").select(*order)


SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters_sql(s: Settings = Settings()) -> str:
    """The same from full distances, for DuckDB."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {s.scale}) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {s.size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS k, v AS c
  FROM (SELECT sha256('{s.salt}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {s.clusters}))""",
    ]
    for i in range(s.rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS m
  FROM (SELECT r, vec_id, v, k,
          CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM kept CROSS JOIN c{i})
  GROUP BY r)"""
        )
        if i < s.rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT o.k, coalesce(m.c, o.c) AS c
  FROM c{i} o LEFT JOIN (
    SELECT k, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
    FROM (SELECT m.k AS k, j, sum(v[j]) AS t, count(*) AS n FROM a{i}, range(1, {s.size + 1}) AS x(j) GROUP BY m.k, j)
    GROUP BY k) m ON m.k = o.k)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
  CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{s.rounds} JOIN c{s.rounds} ON c{s.rounds}.k = m.k"""
