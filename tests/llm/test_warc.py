from __future__ import annotations

import hashlib

import pytest

from leaguelake.llm import warc
from leaguelake.llm.warc import END, MAGIC, read_archives, round_trip, write_archives

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    out = []
    tops = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page is not None:
            tops[payload] = max(tops.get(payload, page), page)
    for page, _, html in rows:
        payload = (html or "").encode()
        top = tops.get(payload)
        revisit = top is not None and page != top
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def fake(i: int) -> str:
    """A payload that is itself a record whose length leads exactly to the next true one."""
    body = "inner " * 10
    return f"{MAGIC}WARC-Type: response{END[:2]}WARC-Record-ID: <fake-{i}>{END[:2]}Page-Id: {900 + i}{END[:2]}Content-Length: {len(body)}{END}{body}"


ROWS = [
    (1, "http://a.example/x", "é" * 600),
    (2, "http://a.example/y", "é" * 600),
    (3, None, "é" * 600),
    (4, "u", None),
    (5, "u", ""),
    (6, "u\r\nWARC-Type: nothing", "short"),
    (7, "u", "short"),
    (8, "u", f"before {MAGIC} after {MAGIC}{MAGIC} end" * 3),
    (9, "u", fake(9)),
    (10, "u", fake(10) + END + fake(11)),
    (11, "u", "x" * 999),
    (12, "u", "x" * 999),
    (13, "u", "\r\n\r\n" + "y" * 2000 + "\r\n\r\n"),
    (14, "u", "\r\n\r\n" + "y" * 2000 + "\r\n\r\n"),
    (None, "u", "no id"),
    (15, "u", MAGIC),
    (16, "u", ("long text " + MAGIC) * 3000),
]


def result(frame):
    return sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in frame.collect()], key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_round_trip(spark, parts):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    assert result(round_trip(pages)) == brute(ROWS)


def test_archives_cut_anywhere(spark, tmp_path):
    """Cuts of a few hundred bytes fall inside heads, payloads and the magic itself."""
    pages = spark.createDataFrame(ROWS[:15], SCHEMA).coalesce(1)
    path = str(tmp_path / "archives")
    write_archives(pages, path)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (97, 211):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            assert result(read_archives(spark, path)) == brute(ROWS[:15])
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_repeated_rows_have_one_response(spark):
    rows = [(7, "u", "z" * 3000)] * 4
    got = result(round_trip(spark.createDataFrame(rows, SCHEMA)))
    assert [r[3] for r in got].count("response") == 1 and {r[4] for r in got if r[3] == "revisit"} == {7}


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scans_that_are_cut_differently_each_time(spark, tmp_path, monkeypatch):
    """As if executors came or went between the jobs."""
    path = str(tmp_path / "pages")
    spark.createDataFrame(ROWS[:15], SCHEMA).repartition(5).write.parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {k: spark.conf.get(k) for k in names}
    cuts = {"warc-copies": ("3000", "1"), "warc-pieces": ("128m", "4m"), "warc-needed": ("3000", "1"), "warc-read": ("128m", "4m")}

    def moved(frame, label, keep=warc.stored):
        out = keep(frame, label)
        for name, value in zip(names, cuts.get(label, ()), strict=False):
            spark.conf.set(name, value)
        return out

    monkeypatch.setattr(warc, "stored", moved)
    try:
        assert result(round_trip(spark.read.parquet(path), stable=True)) == brute(ROWS[:15])
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
