from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from leaguelake.llm import urls
from leaguelake.llm.urls import RULES, best_cut, judged, run_counts, with_log_ratio

SCHEMA = "page_id long, url string, html string"
URLS = [
    "http://a.example.com/en/1", "https://WWW.Example.COM/en/x?y#z", "http://www.example.com/de/2", "HTTP://x.net/es/",
    "http://net/fr/1", "http://notnet/fr/1", "http://x.NET/frx", "ftp://example.org/en/", "http://com", "http://com/", "http://examplecom/",
    "no scheme", None, "", "://", "a://b://c.com/d", "http://x.com?en/", "http://x.com#/", "http://user@h.com:80/p q/é?", "http://ÀÉ.com/Ä",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def pages(spark, urls_):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls_)], SCHEMA).repartition(3)


def random_urls(n):
    rng = random.Random(3)
    good = ["shop", "news", "garden", "music", "open"]
    out = []
    for i in range(n):
        if rng.random() < 0.5:
            out.append(f"http://{rng.choice(good)}{rng.randrange(40)}.{rng.choice(['com', 'org'])}/de/{i}")
        else:
            out.append(f"http://xxx{rng.randrange(99)}-pills.{rng.choice(['net', 'info'])}/{rng.choice(['es', 'fr'])}/{i}")
    return out


def test_rules_equal_brute_force(spark):
    got = {r.page_id: (r.host, r.path, r.rule) for r in judged(pages(spark, URLS)).collect()}
    assert got == {i: brute(u)[:3] for i, u in enumerate(URLS)}
    verdicts = {r.page_id: r.verdict for r in judged(pages(spark, URLS)).collect()}
    assert all(verdicts[i] == brute(u)[3] for i, u in enumerate(URLS) if brute(u)[3])
    assert set(verdicts.values()) <= {"allow", "block"}


def test_models_separate_what_rules_do_not_decide(spark):
    texts = random_urls(3000)
    got = judged(pages(spark, texts)).collect()
    unruled = [r for r in got if r.rule is None]
    right = sum((r.verdict == "block") == ("pills" in texts[r.page_id]) for r in unruled)
    assert len(unruled) > 500 and right / len(unruled) > 0.95


def plain_scores(texts, taught):
    """Mean difference by text: one character at a time, from order 0 up."""
    line = lambda text: "\0" * urls.ORDER + text + "\0"
    seen = {side: defaultdict(Counter) for side in (True, False)}
    for side, lessons in taught.items():
        for text in map(line, lessons):
            for i in range(urls.ORDER, len(text)):
                for order in range(urls.ORDER + 1):
                    seen[side][text[i - order : i]][text[i]] += 1
    characters = set("\0".join(sum(taught.values(), [""])) + "\0")

    def likelihood(side, text):
        total = 0.0
        for i in range(urls.ORDER, len(text)):
            p = 1 / (len(characters) + 1)
            for order in range(urls.ORDER + 1):
                c = seen[side].get(text[i - order : i])
                if c:
                    p = (c[text[i]] + len(c) * p) / (sum(c.values()) + len(c))
            total += math.log(p)
        return total

    return [(likelihood(True, line(t)) - likelihood(False, line(t))) / (len(t) + 1) if t else 0.0 for t in texts]


def test_scores_equal_a_plain_model(spark):
    taught = {True: ["news.com/a", "abc.com/b", "", "aéb", "日本.jp"], False: ["pills.net/es/", "pi.net", "日曜"]}
    texts = ["news.net/es/", "abc", "", "zz9", "pills.com", "é", "日本", "日", "x" * 3000 + "news"]
    lessons = spark.createDataFrame([(t, side) for side, ts in taught.items() for t in ts], "address string, accepted boolean")
    addresses = spark.createDataFrame(list(enumerate(texts)), "number long, address string")
    got = {r.number: r.log_ratio for r in with_log_ratio(addresses, run_counts(lessons)).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], plain_scores(texts, taught), atol=2e-6)


def test_verdicts_equal_brute_force_and_joins_agree(spark):
    """All rows of the query against plain Python, with broadcast joins and with shuffled ones."""
    texts = random_urls(400) + URLS + ["http://x.net/ES/a", "http://x.net/es/a"]
    small = pages(spark, texts)
    got = sorted(map(tuple, judged(small).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, judged(small).collect())) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def low(url):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")

    sides = {(low(u), brute(u)[3] == "allow") for u in texts if brute(u)[3]}
    held_out = lambda text: zlib.crc32(text.encode()) % 5 == 0
    taught = {side: sorted(t for t, s in sides if s == side and not held_out(t)) for side in (True, False)}
    tests = sorted((t, s) for t, s in sides if held_out(t))
    bins = Counter()
    for (_, side), score in zip(tests, plain_scores([t for t, _ in tests], taught), strict=True):
        bins[(min(urls.BINS - 1, max(0, math.floor(round(score, 6) / urls.BIN) + urls.BINS // 2)), side)] += 1
    cut = best_cut(bins)
    scores = plain_scores([low(u) for u in texts], taught)
    want = [(i, *brute(u)[:3], brute(u)[3] or ("allow" if s >= cut else "block")) for i, (u, s) in enumerate(zip(texts, scores, strict=True))]
    close = {i for i, s in enumerate(scores) if abs(s - cut) < 1e-5}
    assert [row[:5] for row in got if row[0] not in close] == [row for row in want if row[0] not in close]


def test_clashing_columns_and_a_very_long_url(spark):
    texts = random_urls(60) + ["http://h.org/" + "long/" * 40_000]
    rows = pages(spark, texts)
    for name in ("run", "address", "number", "score", "log_ratio", "accepted", "ruled", "rule", "host", "suffix1"):
        rows = rows.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, judged(rows).collect()))
    assert got == sorted(map(tuple, judged(pages(spark, texts)).collect())) and len(got) == 61


def test_cut_separates():
    assert -0.5 <= best_cut({(900, False): 5, (1100, True): 7}) <= 1.0


def test_one_kind_or_none(spark):
    assert {r.verdict for r in judged(pages(spark, ["http://a.com/x", "http://b.org/"])).collect()} == {"allow"}
    assert judged(pages(spark, ["x"]).where("page_id < 0")).count() == 0


def test_models_see_the_whole_url(spark):
    taught = random_urls(600)
    more = ["free-pills.example.net/x", "news7.org/de/1", "http://h.org/a?q=xxx-pills", "http://h.org/a?q=garden", "http://h.org/a#shop", None, ""]
    got = {r.page_id - 600: r.log_ratio for r in judged(pages(spark, taught + more)).collect() if r.page_id >= 600}
    assert got[0] < 0 and len({got[i] for i in range(5)}) == 5 and got[5] == got[6] == 0
