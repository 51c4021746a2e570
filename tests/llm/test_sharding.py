from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from leaguelake.llm.sharding import shard_by_bytes, sharded
from rows import awkward, documents

ORDER = ("doc_id", "size", "text_crc32", "shard", "slot")


def plain(rows, shards, row_bytes=8):
    """The rule on one list: documents in order, each in the share of the bytes its middle falls into."""
    sized = [(i, len((t or "").encode()) + row_bytes, zlib.crc32((t or "").encode())) for i, t in rows]
    sized.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, before, out, slots = sum(r[1] for r in sized), 0, [], defaultdict(int)
    for doc_id, size, crc in sized:
        shard = (2 * before + size) * shards // (2 * total)
        out.append((doc_id, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r[c] for c in ORDER) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, "w" * rng.choice([0, 1, 40, 700])) for i in rng.sample(range(-50, 5000), 400)]
    out += [(77, "same text")] * 150 + [(78, f"other {i % 3}") for i in range(90)]  # hot and repeated ids
    out += [(None, None)] * 5 + [(None, "ü" * 30), (2500, "x" * 60_000)]  # one text of several shards' size
    rng.shuffle(out)
    return out + awkward()


@pytest.mark.parametrize("shards", [1, 2, 24, 1000])
def test_equals_one_sorted_list(spark, rows, shards):
    assert got(shard_by_bytes(documents(spark, rows), shards)) == plain(rows, shards)


def test_equal_shares_and_gapless_slots(spark, rows):
    found = sharded(documents(spark, rows)).collect()
    assert len(found) == len(rows) and {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    total, largest = sum(r.size for r in found), max(r.size for r in found)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert set(by) <= set(range(24))
    for own in by.values():
        assert abs(sum(r.size for r in own) - total / 24) <= largest
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_even_documents_fill_every_shard_evenly(spark):
    found = sharded(documents(spark, [(i, "x" * 92) for i in range(2400)])).groupBy("shard").count().collect()
    assert {(r.shard, r["count"]) for r in found} == {(i, 100) for i in range(24)}


def test_clashing_columns_one_row_and_no_rows(spark, rows):
    names = ("size", "row", "part", "shard", "slot", "place", "bytes", "law", "first_place", "text_crc32")
    more = documents(spark, rows[:60]).selectExpr("*", *[f"'x' AS {n}" for n in names])
    assert got(sharded(more)) == plain(rows[:60], 24)
    assert got(sharded(documents(spark, [(5, None)]))) == plain([(5, None)], 24) == [(5, 8, 0, 12, 0)]
    empty = sharded(documents(spark, [(1, "a")]).where("doc_id < 0"))
    assert empty.collect() == [] and empty.columns[:6] == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
