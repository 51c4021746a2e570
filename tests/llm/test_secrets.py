from __future__ import annotations

import hashlib
import random
import re

import pytest

from leaguelake.llm.secrets import MASK, redact, scan
from rows import awkward, documents

BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
KEY = "AKIA" + "Z9" * 8
TEXTS = [
    (100, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and token:"password: abcdefghijklmn"'),
    (101, "Passwd='hunter2hunter2' API_KEY: abc.def-ghi_jkl apikey=0123456789ab secret=short"),
    (102, f"é🎉 {KEY} ü password=tiny12 deadbeefdeadbeef AKIASHORT AKIAAKIA{KEY}"),
    (103, "password=tiny12 and nothing beside it"),
    (104, "password=tiny12 " + "x " * 300 + f"{KEY}"),
    (105, "user=alice password: wonder1 host=db.example.com postgres://db.example.com/x"),
    (106, "host=db.example.com user=alice"),
    (107, "token=token=token=" * 50 + "secret" * 30),
    (108, "0123456789abcdef" * 3 + " " + "g0123456789abcde"),
    (109, "token\n=\nabcdefghijklmnop token = = abcdefghijklmnop toKen=abcdefghijklmnop"),
    (110, "a1b2 " * 3000 + "secret:abcdefghijkl"),
]


def brute(text: str | None) -> tuple:
    spans = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    joined = ",".join(s for _, _, s in sorted(spans))
    counts = [sum(o == i for _, o, _ in spans) for i in range(3)]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


@pytest.fixture(scope="module")
def found(spark):
    return scan(documents(spark, awkward() + TEXTS)).collect()


def test_base_equals_brute_force(found):
    got = sorted(str((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)) for r in found)
    assert got == sorted(str((i, *brute(t))) for i, t in awkward() + TEXTS)


def test_weak_parts_need_their_complement(found):
    spans = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in found}
    assert "weak" in spans[102]
    assert spans[103] == [] and spans[106] == []
    assert spans[104] == ["access"]
    assert sorted(spans[105]) == ["account", "address", "host", "weak"]


LONG_VALUE = "Zq9/" * 225
SCOPED = [
    (1, f'{{"token": "{LONG_VALUE}", "client_id": "abcdef"}}'),
    (2, f'{{"client_id": "abcdef", "token": "{LONG_VALUE}"}}'),
    (3, "client_id=abcdef " + "Ab3+" * 30),
    (4, f"client_id=abcdef {'. ' * 95} password=tiny12"),
    (5, f"client_id=abcdef {'. ' * 105} password=tiny12"),
    (6, f"password=tiny12 {LONG_VALUE} client_id=abcdef"),
]


def test_scopes_reach_from_end_to_start(spark):
    kinds = {r.doc_id: [x.split(":")[0] for x in r.spans.split(",") if x] for r in scan(documents(spark, SCOPED)).collect()}
    assert "account" in kinds[1] and "account" in kinds[2]
    assert sorted(kinds[3]) == ["account", "opaque"]
    assert sorted(kinds[4]) == ["account", "weak"] and kinds[5] == []
    assert sorted(kinds[6]) == ["account", "opaque"]  # the short value ends too far before the name
    masked = {r.doc_id: r.text for r in redact(documents(spark, SCOPED)).collect()}
    assert all(LONG_VALUE not in t for t in masked.values()) and "Ab3+" not in masked[3] and "abcdef" not in masked[1]


def test_linking_equals_comparing_all_parts(spark):
    """Every weak part against every other part of its text, by distance from end to start."""
    from leaguelake.llm.secrets import NEEDS, PARTS, SCOPE

    rng = random.Random(8)
    pieces = ["client_id=abcdef", "password=tiny12", "Ab3+" * 30, KEY, "host=db.example.com", "https://x.example/y", "token=" + "q" * 300]
    texts = [(i, " ".join(rng.choice(pieces) + " ." * rng.choice([1, 60, 99, 101, 130]) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    for r in scan(documents(spark, texts)).collect():
        spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in r.spans.split(",") if x))
        every = []
        for part in PARTS:
            for m in re.finditer(part.pattern, dict(texts)[r.doc_id], re.A):
                if part.least <= len(m[part.group]) <= part.most:
                    every.append((m.start(), m.end(), part))

        def beside(a, b, role):
            return any(p.role == role and c - b <= SCOPE and a - d <= SCOPE for c, d, p in every)

        want = sorted((a, b, p.kind) for a, b, p in every if p.base or all(beside(a, b, x) for x in NEEDS[p.role]))
        assert spans == want, dict(texts)[r.doc_id]


def test_base_spans_stay(found):
    for r in found:
        base = [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_redaction_masks_spans_and_keeps_the_rest(spark):
    texts = awkward() + TEXTS
    before = documents(spark, texts)
    after = redact(before)
    assert after.columns == before.columns and after.count() == len(texts)
    got = {r.doc_id: r for r in after.where("doc_id >= 100").collect()}
    assert got[100].text == f'{MASK}" and {MASK}' or MASK in got[100].text
    assert "24be6443" not in got[100].text
    assert got[102].text.startswith(f"é🎉 {MASK} ü {MASK}")
    assert got[103].text == TEXTS[3][1]
    assert all(r.n_chars == len(r.text) for r in got.values())
    clean = {r.doc_id: r.text for r in after.where("doc_id < 100").collect()}
    assert clean[1] is None and clean[2] == "" and clean[9] == "a b c d e " * 2000


def test_redaction_equals_the_spans(spark):
    texts = [(i, t) for i, t in TEXTS]
    spans = {r.doc_id: r.spans for r in scan(documents(spark, texts)).collect()}
    for r in redact(documents(spark, texts)).collect():
        text, cover = dict(texts)[r.doc_id], set()
        for s in filter(None, spans[r.doc_id].split(",")):
            _, a, b = s.split(":")
            cover |= set(range(int(a), int(b)))
        ends = {int(s.split(":")[1]) for s in filter(None, spans[r.doc_id].split(","))}
        out, i = "", 0
        while i < len(text):
            if i in cover:
                out += MASK
                while i in cover:
                    i += 1
            else:
                out, i = out + text[i], i + 1
        assert r.text == out, (r.doc_id, ends)


def test_empty_table(spark):
    empty = documents(spark, {1: ""}).where("doc_id < 0")
    assert scan(empty).count() == 0 and redact(empty).count() == 0
