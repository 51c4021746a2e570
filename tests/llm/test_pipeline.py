"""Every stage over the smallest tables against a plain version of its decision."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline as pipeline
from leaguelake.llm.quality import scored
from leaguelake.llm.secrets import MASK
from leaguelake.llm.tables import table
from rows import awkward, documents
from test_decontaminate import plain_alignment, tokens
from test_jaccard import shingles
from test_packing import check_places

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage returned, written and read again."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_stay(steps):
    for frame in steps[1:-1]:
        assert frame.dtypes == steps[0].dtypes


def test_quality(spark, steps):
    accepted = {r.doc_id for r in scored(steps[0], table(spark, SF, "labels")).collect() if r.predicted}
    assert set(rows(steps[1])) == accepted
    known = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good, bad = ([i for i, q in known.items() if q == want] for want in (1, 0))
    assert sum(i in accepted for i in good) >= 0.95 * len(good)
    assert sum(i in accepted for i in bad) < 0.5 * len(bad)


def test_one_of_each_group(steps):
    before, after = rows(steps[1]), rows(steps[2])
    sets = {i: shingles(t) for i, t in before.items()}
    expected, group = set(before), {i: {i} for i in before}
    for i in before:
        for j in before:
            if j < i and sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]) and group[i] is not group[j]:
                group[i] |= group[j]
                for k in group[i]:
                    group[k] = group[i]
    expected = {min(g) for g in group.values()}
    assert set(after) == expected and all(after[i] == before[i] for i in after)


def test_decontamination(spark, steps):
    before, after = rows(steps[2]), rows(steps[3])
    items = [tokens(r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = set()
    for i, text in before.items():
        words = tokens(text)
        for item in items:
            near = set(zip(item, item[1:], item[2:])) & set(zip(words, words[1:], words[2:]))
            if near and plain_alignment(words, item) >= len(item):
                dirty.add(i)
    assert set(after) == set(before) - dirty and dirty


def test_secrets(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(before) == set(after)
    for i, text in after.items():
        assert not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", text)
        assert text == before[i] or MASK in text
    assert any(MASK in t for t in after.values())
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_packing(steps):
    found = steps[5].collect()
    assert {r.doc_id for r in found} == set(rows(steps[4]))
    n, tokens_ = check_places(found, 2048), sum(r.length for r in found)
    assert n <= 1.05 * tokens_ / 2048 + 2


def test_run_equals_the_stages(spark, steps):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = pipeline.run(spark, SF).select(*key).collect()
    assert sorted(got) == sorted(steps[5].select(*key).collect())


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    frame = documents(spark, awkward()).selectExpr("*", "1 AS row", "'x' AS score", "2 AS n", "3 AS root")
    frame.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for i, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        result = stage(spark, docs, SF)
        assert result.columns == docs.columns
        result.write.parquet(str(tmp_path / str(i)))
        assert stage(spark, docs.where("doc_id < 0"), SF).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() >= len(awkward())
