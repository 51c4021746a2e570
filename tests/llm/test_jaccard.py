from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from leaguelake.llm import jaccard
from leaguelake.llm.graph import components
from leaguelake.llm.jaccard import (
    early_length,
    folded,
    keep_one,
    may_overlap,
    near_duplicates,
    overlap,
    parity_bits,
    prefix_length,
    shingle_sets,
)
from leaguelake.llm.textbuf import blocks
from rows import awkward, documents

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 4 * len(x & y) >= 3 * len(x | y):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return sorted(str((doc, len(sets[i]), ids.get(find(i)))) for i, (doc, _) in enumerate(rows))


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def families(seed):
    """Copies, near copies at every distance round the limit, chains, and texts made of shared passages."""
    rng = random.Random(seed)
    out = []
    for f in range(25):
        base = [f"w{f}x{rng.randrange(10**6)}" for _ in range(rng.choice([6, 9, 40, 120]))]
        for k in range(rng.choice([1, 3, 8])):
            out.append(edited(rng, base, k))
        out += [" ".join(base)] * rng.choice([0, 2])
        chain = list(base)
        for _ in range(3):
            chain = edited(rng, chain, max(1, len(chain) // 45)).split()
            out.append(" ".join(chain).upper())
    passages = [[f"p{p}n{i}" for i in range(14)] for p in range(14)]
    for _ in range(170):
        chosen = rng.sample(range(14), 11)
        out.append("  ".join(w for p in sorted(chosen) for w in passages[p]))
    rng.shuffle(out)
    return list(enumerate(out, 100))


def result(frame):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    return families(1) + awkward()


def test_equals_brute_force(spark, rows):
    assert result(near_duplicates(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("spanning", [True, False])
def test_long_runs(spark, rows, monkeypatch, spanning):
    """Without stars everything has to be found by prefixes; without spanning links by all pairs of tiles."""
    seen = []
    tile_pairs, none = jaccard._tile_pairs, lambda rows, *_: rows.selectExpr("row AS a", "row AS b").where("a < 0")
    monkeypatch.setattr(jaccard, "_tile_pairs", lambda r, s: seen.append(r.count()) or tile_pairs(r, s))
    monkeypatch.setattr(jaccard, "_star_pairs", lambda sets, members: none(members))
    if not spanning:
        monkeypatch.setattr(jaccard, "_spanning_links", none)
    assert result(near_duplicates(documents(spark, rows))) == brute(rows)
    assert spanning or seen[0] > 100


def test_one_of_each_group_stays(spark, tmp_path, rows):
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    found = near_duplicates(docs).collect()
    assert kept.count() == len({r.root for r in found})
    ids = [r.doc_id for r in kept.collect()]
    assert {r.component_id for r in found if r.component_id is not None} <= set(ids)


def test_one_of_each_group_stays_however_scans_are_cut(spark, tmp_path, monkeypatch):
    """As if executors came or went between the jobs."""
    texts = [(i, " ".join(f"w{(i // 2) * 100 + j}" for j in range(30))) for i in range(40)]
    documents(spark, texts).repartition(6).write.parquet(str(tmp_path / "docs"))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}

    def moved(frame, label, keep=jaccard.stored):
        out = keep(frame, label)
        if label == "shingle-dropped":
            for name, value in zip(names, ("900", "1"), strict=True):
                spark.conf.set(name, value)
        return out

    monkeypatch.setattr(jaccard, "stored", moved)
    try:
        kept = keep_one(spark.read.parquet(str(tmp_path / "docs"))).collect()
        assert sorted(r.doc_id for r in kept) == list(range(0, 40, 2))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bitmaps_never_exclude_a_link():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n, m = rng.integers(1, 300, 2)
        shared = rng.integers(0, min(n, m) + 1)
        pool = rng.integers(0, 1 << 63, n + m - shared, dtype=np.int64).astype(np.uint64)
        x, y = np.unique(pool[:n]), np.unique(pool[n - shared :])
        keys = np.concatenate((x, y))
        bits = parity_bits(keys, np.array([0, len(x), len(keys)]))
        width = min(map(len, bits)) * 8
        differ = int(np.bitwise_count(folded(bits[0], width) ^ folded(bits[1], width)).sum())
        common = overlap(x, y)
        assert common == len(np.intersect1d(x, y)) and differ <= len(x) + len(y) - 2 * common
        if 100 * common >= 75 * (len(x) + len(y) - common):
            assert may_overlap(len(x), len(y), differ)


def test_words_of_a_regular_structure_are_told_apart(spark):
    odd = [i.bit_count() & 1 for i in range(1024)]
    texts = ["".join("ab"[x] for x in odd), "".join("ba"[x] for x in odd)]
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[0]), (4, f"w x y {texts[0]} z"), (5, f"w x y {texts[1]} z")]
    assert result(near_duplicates(documents(spark, rows))) == brute(rows)


def test_recurring_shingles():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 12)).astype(np.uint64) << np.uint64(16) for _ in range(9)]
    keys, times = jaccard.recurring([jaccard._pack(x).ravel() for x in sets])
    every, n = np.unique(np.concatenate(sets) >> np.uint64(16), return_counts=True)
    assert keys.tolist() == every[n > 1].tolist() and times.tolist() == n[n > 1].tolist()


def test_shingle_sets_do_not_depend_on_blocks():
    texts = [t for _, t in awkward()]
    seen = []
    for limit in (1, 100, 1 << 22):
        found = []
        for block in blocks(pa.array(texts), limit):
            keys, bounds = shingle_sets(block)
            found += [keys[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        seen.append(found)
    assert seen[0] == seen[1] == seen[2]
    assert [len(x) for x in seen[0]] == [len(shingles(t)) for t in texts]


def test_prefix_length_is_what_a_link_needs():
    for n in range(1, 200):
        least = min(k for k in range(n + 1) if 100 * k >= 75 * n)
        assert prefix_length(np.array([n]))[0] == n - least + 1
        # with a set of the same or a larger size
        least = min(k for m in range(n, 2 * n) for k in range(n + 1) if 100 * k >= 75 * (n + m - k))
        assert early_length(np.array([n]))[0] == n - least + 1


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(9, 9)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.row, r.root) for r in got) == sorted((x, find(x)) for x in linked)


def test_empty_table(spark):
    empty = documents(spark, {1: ""}).where("doc_id < 0")
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0
