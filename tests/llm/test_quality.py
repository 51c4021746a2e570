from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from leaguelake.llm.quality import Settings, count_neighbours, pooled, scored, tokens, train, with_quality
from leaguelake.llm.textbuf import blocks
from leaguelake.llm.tables import table
from rows import awkward, documents

SMALL = Settings(rows=64, width=8, lessons=200, epochs=20)
TEXTS = ["ab cd!! é1\n--x", "", None, "...", "Ab ab AB " * 50, " \t", "one"]


def test_tokens_equal_a_regular_expression():
    pattern = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")
    for limit in (1, 1 << 20):
        counts, seen = [], {}
        for block in blocks(pa.array(TEXTS), limit):
            hashes, bounds = tokens(block)
            counts += np.diff(bounds).tolist()
            found = [t for i in range(len(block)) for t in pattern.findall(block.text(i).encode())]
            for t, h in zip(found, hashes, strict=True):
                assert seen.setdefault(t, h) == h
        assert counts == [len(pattern.findall((t or "").encode())) for t in TEXTS]
        assert len(set(seen.values())) == len(seen)


def test_table_does_not_depend_on_blocks():
    totals = []
    for limit in (1, 40, 1 << 20):
        total = np.zeros(SMALL.rows * SMALL.width, np.int64)
        for block in blocks(pa.array(TEXTS), limit):
            count_neighbours(block, total, SMALL)
        totals.append(total)
    assert (totals[0] == totals[1]).all() and (totals[0] == totals[2]).all() and totals[0].any()


def test_pooling_equals_means():
    table = np.random.default_rng(0).normal(size=(SMALL.rows, SMALL.width)).astype(np.float32)
    for block in blocks(pa.array([*TEXTS, "w! " * 40_000])):
        hashes, bounds = tokens(block)
        got = pooled(block, table, SMALL)
        for i in range(len(block)):
            rows = table[(hashes[bounds[i] : bounds[i + 1]] % np.uint64(SMALL.rows)).astype(int)].astype(float)
            want = np.concatenate((rows.mean(0), (rows * rows).mean(0))) if len(rows) else np.zeros(2 * SMALL.width)
            alike = [(rows[:-far] * rows[far:]).sum() / max(len(rows), 1) for far in (2, 1)]
            assert np.allclose(got[i, :-1], np.concatenate((want, alike))) and got[i, -1] == pytest.approx(np.log1p(len(rows)))


def test_training_learns_and_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 6))
    y = (rng.random(2000) < 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))).astype(int)
    p = train(x, y, SMALL).scores(x)
    assert np.mean((p > 0.5) == y) > 0.7 and abs(p.mean() - y.mean()) < 0.05


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = scored(table(spark, sf, "documents"), table(spark, sf, "labels"))
    known = rows.join(table(spark, sf, "labels"), "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    right = (known.predicted == known.quality).mean()
    bad = known[known.quality == 0]
    assert right > 0.95 and (bad.predicted == 0).mean() > 0.8
    positive, negative = known.score[known.quality == 1].to_numpy(), bad.score.to_numpy()
    assert np.mean(positive[:, None] > negative[None, :]) > 0.95


def test_awkward_rows_and_labels(spark):
    docs = documents(spark, awkward()).selectExpr("*", "'x' AS quality_score", "1 AS quality", "2 AS held_out")
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (9, 0, 1), (9, 1, 1), (11, None, None), (None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = scored(docs, labels).collect()
    assert len(got) == len(awkward())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3, 15)}) == 1


def test_one_kind_of_label_none_and_empty_table(spark):
    docs = documents(spark, {1: "a", 2: "b", 3: None})
    schema = "doc_id long, quality int, toxic int"
    ones = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3)], schema)
    assert {r.quality_score for r in with_quality(docs, ones).collect()} == {1.0}
    assert {r.quality_score for r in with_quality(docs, ones.where("doc_id < 0")).collect()} == {0.5}
    assert scored(docs.where("doc_id < 0"), ones).count() == 0
