from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from leaguelake.llm import packing
from leaguelake.llm.packing import Encoder, packed, places, plan, sequences, tokenizer_path
from rows import awkward, documents

HARD = [
    "it's we'll I'D they've 'salt '' !'s 12²½ x³ ªº µm ß Straße ÀÉÎ ÿ",
    "tab\tvt\x0bff\x0cnel\x85nbsp\xa0end \x1c\x1d\x1e\x1f x",
    "<|endoftext|> a <|startoftext|>b <| c",
    "é ﬁ İstanbul ΣΊΣΥΦΟΣ 中文 🎉🎉 ½Ⅷ  wide​zero",
    "(c) §§ ¶ «quoted» ¡hola! ¿qué? £5 10% a_b-c/d",
    "",
    "   ",
    "A" * 3000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    rng = random.Random(1)
    latin = [chr(c) for c in range(1, 256)]
    texts = HARD + [t or "" for _, t in awkward()] + ["".join(rng.choices(latin, k=200)) for _ in range(200)]
    for memory, segment in ((300_000, 1 << 20), (40, 16)):
        monkeypatch.setattr(packing, "MEMORY", memory)
        monkeypatch.setattr(packing, "SEGMENT", segment)
        for text, got in zip(texts, Encoder(tokenizer_path()).encode(texts), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(tokenizer, text)[:-1], text


def check_places(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def test_pieces_and_sequences(spark, tokenizer):
    texts = awkward() + [(100 + i, t) for i, t in enumerate(HARD)] + [(200 + i, "lorem ipsum dolor " * (i * 7)) for i in range(120)]
    rows = packed(documents(spark, texts), with_ids=True)
    found = rows.collect()
    got, want = [], []
    for r in found:
        got.append(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)))
    for doc_id, text in texts:
        ids = ids_of(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append(str((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))))
    assert sorted(got) == sorted(want)
    n = check_places(found, 2048)
    tokens = sum(r.length for r in found)
    assert -(-tokens // 2048) <= n <= -(-tokens // 2048) * 1.1 + 2
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(rows).collect()}
    for r in found:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    length = [10, 50, 2048][seed % 3]
    counts = np.zeros(length + 1, np.int64)
    for n in rng.integers(1, length + 1, 40):
        counts[n] += rng.integers(1, 10**6)
    steps = plan(counts, length)
    used = np.zeros_like(counts)
    for pattern, times in steps:
        assert sum(pattern) <= length and times > 0
        used += times * np.bincount(pattern, minlength=len(used))
    assert (used == counts).all()
    assert sum(t for _, t in steps) >= -(-int((counts * np.arange(length + 1)).sum()) // length)
    taken = {n: 0 for n in range(length + 1)}
    for n, (first, _, _) in places(steps).items():
        assert first[0] == 0 and (np.diff(first) > 0).all()
        taken[n] = 1
    assert all(bool(counts[n]) == bool(taken[n]) for n in taken)


def test_complements_fill_exactly():
    for lengths in ([70, 30], [50, 30, 20], [40, 30, 20, 10], [50, 50], [25, 25, 25, 25], [40, 20, 20, 20]):
        counts = np.zeros(101, np.int64)
        for n in lengths:
            counts[n] += 5
        assert sum(t for _, t in plan(counts, 100)) == 5


def test_few_sequences_on_mixed_lengths():
    rng = np.random.default_rng(9)
    counts = np.bincount(np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2048), minlength=2049)
    total = int((counts * np.arange(2049)).sum())
    assert sum(t for _, t in plan(counts)) <= -(-total // 2048) * 1.002 + 1


def test_empty_table(spark):
    assert packed(documents(spark, {1: ""}).where("doc_id < 0")).count() == 0
