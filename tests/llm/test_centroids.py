from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from leaguelake.llm.centroids import SCHEMA, Settings, clustered, clusters_sql, corrected
from leaguelake.llm.tables import table
from oracle_check import connect, differences


def plain(rows, s):
    """The same with Python's whole numbers and full distances; None where a long cannot hold them."""
    kept = [
        (i, [math.floor(float(x) * s.scale) for x in v])
        for i, v in rows
        if v is not None and len(v) == s.size and all(x is not None and math.isfinite(x) for x in v)
    ]

    def start(row):
        return hashlib.sha256((s.salt + ("" if row[0] is None else str(row[0]))).encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted(kept, key=start)[: s.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(s.rounds):
        of = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            own = [v for (_, v), j in zip(kept, of) if j == k]
            if own:
                centroids[k] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return sorted(
        (str(i), k, d, sum(e for _, e, j in found if j == k), total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
        for i, d, k in found
    )


def got(frame):
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, v string, cluster int, distance string, e int, dots int"
    return spark.createDataFrame([(i, v, 0, "x", 7, "y", 1, 2) for i, v in rows], schema).repartition(3)


def test_equals_plain_rounds_on_awkward_rows(spark):
    rng = np.random.default_rng(3)
    s = Settings(size=4, clusters=5, rounds=4)
    points = [(i, (rng.integers(-40, 40, 4) / 7).tolist()) for i in range(60)]
    rows = points + points[:5] + [(i, [0.25, -0.25, 0.0, -0.0]) for i in range(100, 140)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 1.0, 1.0])]
    rows += [(204, [1.0, math.nan, 1.0, 1.0]), (205, [math.inf, 0.0, 0.0, 0.0]), (206, [1e-30, -1e-30, 500.0, -500.0])]
    frame = clustered(vectors(spark, rows), s)
    assert [f"{c} {t.replace('bigint', 'long')}" for c, t in frame.dtypes] == SCHEMA.split(", ")
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(frame) == plain(floats, s)


def test_fewer_vectors_than_clusters_equal_vectors_and_none(spark):
    s = Settings(size=2, clusters=3, rounds=2)
    for rows in ([(1, [1.0, 2.0])], [(i, [3.0, 3.0]) for i in range(9)], [(7, [0.5, 0.5])] * 4):
        assert got(clustered(vectors(spark, rows), s)) == plain(rows, s)
    assert clustered(vectors(spark, [(1, [1.0])]), s).collect() == []
    assert clustered(vectors(spark, [(1, [1.0, 1.0])]).where("vec_id < 0"), s).collect() == []


def test_components_too_large_for_a_long_are_refused(spark):
    with pytest.raises(ValueError, match="fit a long"):
        clustered(vectors(spark, [(1, [1e30, 0.0])]), Settings(size=2))


def test_products_are_corrected_not_recomputed():
    rng = np.random.default_rng(5)
    v, old = rng.integers(-(2**27), 2**27, (50, 64)), rng.integers(-(2**27), 2**27, (6, 64))
    new = old.copy()
    new[2, 5], new[4] = 9, rng.integers(-9, 9, 64)
    dots, cluster, distance = corrected(v, v @ old.T, new, new - old)
    full = ((v[:, None, :] - new[None]) ** 2).sum(2)
    assert (dots == v @ new.T).all() and (distance == full.min(1)).all() and (cluster == full.argmin(1)).all()
    wrong, _, _ = corrected(v, v @ old.T + 1, new, new - old)
    assert (wrong == dots + 1).all()


def test_sql_and_plain_agree_with_the_query(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(clustered(table(spark, sf, "embeddings")), connect(sf), clusters_sql()) == []
