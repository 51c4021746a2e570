from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from leaguelake.llm import manifest as m
from leaguelake.llm.tables import table
from oracle_check import connect, differences
from rows import awkward, documents

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """(doc_id, source, lang, n_chars, text) of every row to the contract's columns."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def up(digests):
        """Levels from the leaves to the top, and every leaf's (left, right) by level."""
        sides, at = [[] for _ in digests], list(range(len(digests)))
        while len(digests) > 1:
            runs = [digests[i : i + 8] for i in range(0, len(digests), 8)]
            for i, p in enumerate(at):
                run = runs[p // 8]
                sides[i].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
            digests, at = [sha("".join(r)) for r in runs], [p // 8 for p in at]
        return digests[0], sides

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    tops = {}
    for lang, own in trees.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[lang] = up([leaf(r) for r in own])
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    root, over = up([tops[x][0] for x in names])
    out = []
    for i, lang in enumerate(names):
        for row, own in zip(trees[lang], tops[lang][1], strict=True):
            sides = own + over[i]
            changed = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                changed = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            folded = leaf(changed)
            for left, right in sides:
                folded = sha(left + folded + right)
            out.append((row[0], leaf(row), tops[lang][0], root, sha("".join(a + b for a, b in sides)), folded, folded == root))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r)[:7] for r in frame.collect()), key=str)


def fields(frame):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in frame.collect()]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 511, 512, 513])
def test_sweeps_equal_plain_trees(n):
    digests = [sha(str(i)) for i in range(n)]
    rng = random.Random(n)
    for height in {m.block_levels(n), 3}:
        nodes = list(m.forward(iter(enumerate(digests)), height))
        labels = [m.label(x.level, x.at) for x in nodes]
        assert labels == sorted(labels)
        below = digests
        for level in range(1, height + 1):
            below = [sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)]
            assert [x.digest for x in nodes if x.level == level] == below
        if len(below) > 1:
            continue
        above = m.Proof((("l", "r"),))
        stream = [(x.level, x.at, x.children, None) for x in nodes] + [(0, i, [], i) for i in range(n)]
        stream.sort(key=lambda x: m.label(x[0], x[1]), reverse=True)
        proofs = dict(m.backward(iter(stream), above))
        top = sha("l" + (below[0]) + "r")
        assert set(proofs) == set(range(n))
        for i in rng.sample(range(n), min(n, 20)):
            assert proofs[i].fold(digests[i]) == top and proofs[i].fold(sha("x")) != top
            assert m.Proof.unpacked(proofs[i].packed()) == proofs[i]


def test_awkward_rows(spark):
    docs = documents(spark, awkward() + [(i, f"Row {i}") for i in range(300, 390)])
    docs = docs.selectExpr("*", "'x' AS tree", "1 AS n", "2 AS place", "3 AS digest", "4 AS level", "5 AS at", "6 AS f0")
    langs = docs.selectExpr("* EXCEPT (lang)", "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' WHEN doc_id < 9 THEN 'é' ELSE 'en' END AS lang")
    assert got(m.manifest(langs)) == plain(fields(langs))
    assert m.digests(langs).columns == [c.split()[0] for c in m.RESULT.split(", ")][:-1]


def test_lone_rows_and_none(spark):
    for rows in ([(4, "Lone")], [(None, None)], [(6, "A"), (6, "A")]):
        docs = documents(spark, rows)
        assert got(m.manifest(docs)) == plain(fields(docs))
    assert m.manifest(documents(spark, [(1, "a")]).where("doc_id < 0")).collect() == []


def test_blocks_of_several_passes(spark):
    """Blocks of eight leaves: many passes, trees of different heights, and more languages than a block."""
    docs = documents(spark, [(i * 7 % 613, f"Text {i}") for i in range(620)])
    docs = docs.selectExpr("* EXCEPT (lang)", "CASE WHEN doc_id % 3 > 0 THEN 'en' ELSE concat('l', cast(doc_id % 41 AS string)) END AS lang")
    assert got(m.manifest(docs, height=1)) == plain(fields(docs))


def test_sql_agrees_and_a_tampered_row_fails(spark):
    docs = table(spark, SF, "documents")
    frame = m.digests(docs)
    assert differences(frame, connect(SF), m.manifest_sql()) == []
    rows = {r.doc_id: r for r in frame.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, r in rows.items():
        changed = zlib.crc32(str(i).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in texts[i] or "")
        assert r.verified != changed
