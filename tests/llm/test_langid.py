from __future__ import annotations

import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from leaguelake.llm import langid
from leaguelake.llm.langid import Lookup, Settings, folded, identified, learned, pieces, predicted, runs, shares, softmax, train
from leaguelake.llm.tables import table
from rows import awkward, documents


def plain_runs(text):
    """Runs of one to three characters of the folded text, counted."""
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" or ord(c) > 0xFFFF else " " for c in text)
    words = " " + " ".join(letters.split(" ")) + " "
    while "  " in words:
        words = words.replace("  ", " ")
    return Counter(words[i : i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1) if words[i : i + n] != " ")


def spelled(key):
    return "".join(chr(int(key) >> 21 * i & 0x1FFFFF) for i in range(3) if int(key) >> 21 * i & 0x1FFFFF)


@pytest.mark.parametrize("text", ["", " \n", "Ab c! 7éİß x́ 中文 \U0001d49c\U0001f600", "a", "...", "word " * 50])
def test_runs_equal_slices_of_the_folded_text(text):
    assert Counter(map(spelled, runs(folded(text)))) == plain_runs(text)


def test_long_texts_are_read_whole(monkeypatch):
    text = "Some words, and more of them in Ünïcode. " * 40
    for chunk in (3, 7, 64, 1000):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert Counter(spelled(k) for part in pieces(text) for k in part) == plain_runs(text)


def test_lookup_finds_exactly_what_it_holds():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 5000))
    lookup = Lookup(keys)
    wanted = np.concatenate((keys[::3], rng.integers(0, 1 << 63, 1000), keys[:7]))
    known = {int(k): i for i, k in enumerate(keys)}
    assert sorted(lookup.find(wanted).tolist()) == sorted(known[int(k)] for k in wanted if int(k) in known)
    near = Lookup(np.arange(3000))
    assert sorted(near.find(np.arange(2000, 5000)).tolist()) == list(range(2000, 3000)) and near._probes < 12
    assert len(Lookup(keys[:0]).find(wanted)) == 0


def test_training_equals_a_plain_follow_the_leader():
    rng = np.random.default_rng(2)
    s = Settings(epochs=2, l1=0.05)
    examples = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4)) for _ in range(60)]
    labels = np.array([int(e[0][0]) % 3 for e in examples])
    w, bias = train(examples, labels, 12, 3, s)
    z, n = np.zeros((13, 3)), np.zeros((13, 3))

    def weight(j, c):
        l1, l2 = (s.l1, s.l2) if j < 12 else (0, 0)
        if abs(z[j, c]) <= l1:
            return 0.0
        return -(z[j, c] - np.sign(z[j, c]) * l1) / ((s.damping + np.sqrt(n[j, c])) / s.step + l2)

    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in order.permutation(len(labels)):
            x = {**dict(zip(examples[i][0].tolist(), examples[i][1])), 12: 1.0}
            now = {(j, c): weight(j, c) for j in x for c in range(3)}
            p = softmax(np.array([sum(x[j] * now[j, c] for j in x) for c in range(3)]))
            for j in x:
                for c in range(3):
                    g = x[j] * (p[c] - (c == labels[i]))
                    sigma = (np.sqrt(n[j, c] + g * g) - np.sqrt(n[j, c])) / s.step
                    z[j, c] += g - sigma * now[j, c]
                    n[j, c] += g * g
    assert np.allclose(w, [[weight(j, c) for c in range(3)] for j in range(12)])
    assert np.allclose(bias, [weight(12, c) for c in range(3)])
    assert (train(examples, labels, 12, 3, Settings(epochs=2, l1=1e9))[0] == 0).all()


@pytest.fixture(scope="module")
def judged(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = learned(docs)
    rows = docs.selectExpr("doc_id", "text", "lang", "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 AS held_out")
    found = identified(rows, model).toPandas()
    return model, found, rows.select("doc_id", "text", "lang").toPandas()


def test_held_out_accuracy_and_calibration(judged):
    model, found, rows = judged
    both = found.merge(rows, on="doc_id")
    held = both[both.held_out & both.lang.notna() & (both.lang_pred != "und")]
    right = held.lang_pred == held.lang
    assert len(held) > 2000 and right.mean() > 0.98
    assert abs(held.score.mean() - right.mean()) < 0.03
    assert {"de", "en", "es", "fr"} <= set(model.languages)
    short = held[held.text.str.len() > 30]
    assert (short.lang_pred == short.lang).mean() > 0.985


def test_scores_equal_the_plain_formula(judged):
    model, found, rows = judged
    weights = {spelled(k): w for k, w in zip(model.keys, model.weights.astype(float), strict=True)}
    assert 0 < len(weights) and (model.weights == 0).mean() > 0.05
    texts = rows.set_index("doc_id").text
    for r in found.head(40).itertuples():
        counts = plain_runs(texts[r.doc_id])
        logits = sum((counts[g] / counts.total() * weights[g] for g in counts if g in weights), model.bias.copy())
        p = softmax(logits / model.temperature)
        assert r.lang_pred == model.languages[p.argmax()] and abs(r.score - p.max()) < 1e-6


def test_document_counts_cover_every_text(spark):
    texts = ["ab ab", "AB c", "", "zz " * 30, "c"] * 4
    docs = documents(spark, list(enumerate(texts)))
    keys = np.unique(runs(folded("ab c")))
    counts, n = langid.document_counts(docs.select("text"), keys)
    assert n == 20 and counts.tolist() == [sum(spelled(k) in plain_runs(t) for t in texts) for k in keys]


def test_awkward_rows(spark):
    docs = documents(spark, awkward()).selectExpr("* EXCEPT (lang)", "CASE WHEN doc_id % 2 = 0 THEN 'aa' WHEN doc_id % 5 > 0 THEN 'bb' END AS lang", "1 AS held_out", "2 AS n", "'x' AS lang_pred", "0 AS lettered")
    found = predicted(docs, Settings(lessons=50)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in awkward())
    texts = dict(awkward())
    for r in found:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        if not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in ("aa", "bb") and 0 < r.score <= 1


def test_one_language_none_and_no_rows(spark):
    docs = documents(spark, {i: "some text" for i in range(12)} | {20: None, 21: "1 2 3"})
    by = {r.doc_id: (r.lang_pred, r.score) for r in predicted(docs).collect()}
    assert by[20] == by[21] == ("und", 0) and {by[i] for i in range(12)} == {("en", 1)}
    unknown = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {(r.lang_pred, r.score) for r in predicted(unknown).collect()} == {("und", 0)}
    assert predicted(docs.where("doc_id < 0")).collect() == []


def test_lessons_are_bounded_and_shared_among_languages(spark):
    rows = [(i, f"text {i}", "en" if i % 50 else "xx") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    by = Counter(r.lang for r in langid._lessons(frame, Settings(lessons=100)))
    assert by["xx"] > 25 and 25 < by["en"] < 80 and by.total() <= 200
    assert shares("ab", Lookup(np.unique(runs(folded("ab")))))[1].sum() == pytest.approx(1)
