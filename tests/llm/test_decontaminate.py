from __future__ import annotations

import random
import re

import numpy as np
import pytest

from leaguelake.llm import decontaminate
from leaguelake.llm.decontaminate import GAP, MATCH, MISS, Settings, align, bar, contaminated, without_contaminated
from rows import awkward, documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
S = Settings()


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_alignment(text, item):
    best, row = 0, [0] * (len(text) + 1)
    for word in item:
        fresh = [0] * (len(text) + 1)
        for j, other in enumerate(text, 1):
            fresh[j] = max(0, row[j - 1] + (MATCH if word == other else MISS), row[j] + GAP, fresh[j - 1] + GAP)
            best = max(best, fresh[j])
        row = fresh
    return best


def table_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def corpus():
    rng = random.Random(7)
    common = [f"c{i}" for i in range(60)]
    prose = lambda n: [rng.choice(common) for _ in range(n)]
    items = [(i, " ".join(f"I{i}x{rng.randrange(999)}" if rng.random() < 0.5 else rng.choice(common) for _ in range(rng.choice([12, 25, 50])))) for i in range(12)]
    docs = []
    for k in range(160):
        body = prose(rng.choice([5, 60, 300]))
        if k % 2:
            own = tokens(items[k % 12][1])
            for _ in range(rng.choice([0, 0, 2, 5, 9])):
                edit, at = rng.randrange(3), rng.randrange(len(own))
                own = own[:at] + ([] if edit == 0 else [rng.choice(common)] if edit == 1 else [own[at], "extra"]) + own[at + 1 :]
            at = rng.randrange(len(body))
            body[at:at] = own
        docs.append((1000 + k, ", ".join(body).upper() if k % 3 else "\n".join(body)))
    docs += [(2000 + k, f"before {items[0][1]} after") for k in range(40)]  # a leak as frequent as prose
    return docs, items


def test_align_equals_plain_smith_waterman():
    rng = np.random.default_rng(3)
    for _ in range(60):
        text, item = rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64), rng.integers(0, 6, rng.integers(1, 15)).astype(np.uint64)
        assert align(text, item)[0] == plain_alignment(text.tolist(), item.tolist())


def test_finds_what_aligning_everything_finds(spark):
    docs, items = corpus()
    got = {(r.doc_id, r.item_id): r for r in contaminated(documents(spark, docs), table_of(spark, items)).collect()}
    must = set()
    for doc_id, text in docs:
        words = tokens(text)
        for item_id, item in items:
            own = tokens(item)
            score = plain_alignment(words, own)
            if score >= bar(len(own), S):
                shared = {tuple(own[i : i + 3]) for i in range(len(own) - 2)} & {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
                if len(shared) >= 4:
                    must.add((doc_id, item_id))
            else:
                assert (doc_id, item_id) not in got
    assert must <= set(got) and len(must) > 80
    texts, own_items = dict(docs), dict(items)
    for (doc_id, item_id), r in got.items():
        words = tokens(texts[doc_id])[r.first_word : r.last_word + 1]
        own = tokens(own_items[item_id])
        assert r.score == plain_alignment(words, own) / (2 * len(own)) <= 1


def test_verbatim_item_is_found_whole(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards watch"
    text = f"Intro words here. THE quick, brown fox\njumps over the lazy dog; while seven wizards watch! The end."
    row = contaminated(documents(spark, {5: text}), table_of(spark, [(9, item)])).first()
    assert (row.doc_id, row.item_id, row.score, row.first_word, row.last_word) == (5, 9, 1.0, 3, 15)


def test_blocks_of_items(spark, monkeypatch):
    docs, items = corpus()
    whole = contaminated(documents(spark, docs), table_of(spark, items))
    want = sorted((r.doc_id, r.item_id, r.score) for r in whole.collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 700)
    parts = contaminated(documents(spark, docs), table_of(spark, items))
    assert sorted((r.doc_id, r.item_id, r.score) for r in parts.collect()) == want


def test_filter_keeps_the_clean(spark):
    docs, items = corpus()
    frame = documents(spark, docs + awkward()).selectExpr("*", "1 AS item_id", "2 AS score")
    bad = {r.doc_id for r in contaminated(frame, table_of(spark, items)).collect()}
    kept = without_contaminated(frame, table_of(spark, items))
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs + awkward() if i not in bad)


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (None, "no words in common with any")], [(3, "Apache"), (4, "MIT License")]])
def test_awkward_rows_and_items(spark, items):
    docs = documents(spark, awkward())
    got = contaminated(docs, table_of(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == ({(16, 3), (11, 4)} if (3, "Apache") in items else set())
    assert without_contaminated(docs, table_of(spark, items)).count() == len(awkward()) - len({r.doc_id for r in got})


def test_empty_documents(spark):
    empty = documents(spark, {1: ""}).where("doc_id < 0")
    assert contaminated(empty, table_of(spark, [(1, "a b c d e f g h i")])).count() == 0


def test_a_lone_edited_or_shortened_copy_is_found(spark):
    item = [f"w{i}" for i in range(100)]
    prose = [f"p{i * 7 % 40}" for i in range(80)]
    every = lambda n, own: [f"new{i}" if i % n == 0 else w for i, w in enumerate(own)]
    copies = {1: every(4, item[:50]), 2: every(5, item[:59]), 3: every(9, item), 4: item[:60], 5: item[40:]}
    items = {1: item[:50], 2: item[:59], 3: item, 4: item, 5: item}
    for k, copy in copies.items():
        docs = documents(spark, {k: " ".join(prose + copy + prose), 9: " ".join(prose)})
        want = plain_alignment(copy, items[k]) / (2 * len(items[k]))
        got = contaminated(docs, table_of(spark, [(k, " ".join(items[k]))])).collect()
        assert want >= S.score and [(r.doc_id, r.item_id, r.score) for r in got] == [(k, k, want)]


def test_another_copy_does_not_hide_one_that_keeps_a_single_triple(spark):
    """Whether a row is found must not depend on other rows of the table."""
    item = [f"w{i}" for i in range(30)]
    edited = [f"new{i}" if i < 27 and i % 3 == 2 else w for i, w in enumerate(item)]
    want = plain_alignment(edited, item) / (2 * len(item))
    docs = documents(spark, {1: " ".join(edited), 2: " ".join(item)})
    got = contaminated(docs, table_of(spark, [(7, " ".join(item))])).collect()
    assert want >= S.score and sorted((r.doc_id, r.score) for r in got) == [(1, want), (2, 1.0)]


def test_edits_of_every_kind_equal_aligning_everything(spark):
    rng = random.Random(12)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(rng.choice([9, 20, 45, 90])))) for i in range(30)]
    docs = []
    for k in range(240):
        own = tokens(items[k % 30][1])
        share = rng.choice([0.1, 0.2, 0.3, 0.4])
        kind = rng.randrange(4)
        if kind == 3:
            cut = int(len(own) * share)
            edited = own[cut:] if k % 2 else own[: len(own) - cut]
        else:
            edited = [x for w in own for x in ((w,) if rng.random() > share else ((), ("new",), (w, "more"))[kind])]
        docs.append((k, " ".join([f"p{rng.randrange(30)}" for _ in range(20)] + edited + ["end"])))
    got = {(r.doc_id, r.item_id) for r in contaminated(documents(spark, docs), table_of(spark, items)).collect()}
    want = {(d, i) for d, text in docs for i, item in items[d % 30 : d % 30 + 1] if plain_alignment(tokens(text), tokens(item)) >= bar(len(tokens(item)), S)}
    assert got == want and len(want) > 150


def test_memory_of_an_opening_that_all_items_share(spark):
    """Hits times items is not held at once, and the one item that is there is found."""
    import tracemalloc

    import pyarrow as pa

    from leaguelake.llm.textbuf import blocks

    opening = "which of the following is"
    texts = [(i, f"{opening} " + " ".join(f"i{i}w{k}" for k in range(12))) for i in range(2000)]
    docs = documents(spark, {1: f"{opening} " * 3})
    items = decontaminate.prepared(table_of(spark, texts).collect(), docs, S)
    (block,) = blocks(pa.array([f"{opening} x " * 1000 + texts[77][1]]))
    tracemalloc.start()
    found = decontaminate.matches(block, items, S)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[1] for f in found] == [77] and most < 50 << 20


def test_items_that_repeat_their_triples(spark):
    item = " ".join(["da", "du", "di"] * 20 + [f"x{i}" for i in range(20)])
    text = " ".join(["before"] * 30 + item.split()[30:] + ["after"] * 30)
    row = contaminated(documents(spark, {1: text, 2: "da du di " * 3}), table_of(spark, [(7, item)])).collect()
    assert [(r.doc_id, r.item_id, r.score, r.first_word, r.last_word) for r in row] == [(1, 7, 0.625, 30, 79)]
