from __future__ import annotations

import json

from leaguelake.sinks.documents import (
    bulk_lines,
    bulk_requests,
    document,
    read_bulk,
    with_batch,
    write_bulk,
)

ROWS = [(1, "Zürich", None, None), (2, None, 1.5, 3), (None, None, None, None)]
SCHEMA = "game_id long, team string, win_rate double, rest int"


def test_null_fields_are_left_out_except_those_kept(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    docs = [json.loads(r[0]) for r in df.select(document(df)).collect()]
    assert docs == [{"game_id": 1, "team": "Zürich"}, {"game_id": 2, "win_rate": 1.5, "rest": 3}, {}]
    kept = [json.loads(r[0]) for r in df.select(document(df, ["win_rate", "rest"])).collect()]
    assert kept == [
        {"game_id": 1, "team": "Zürich", "win_rate": None, "rest": None},
        {"game_id": 2, "win_rate": 1.5, "rest": 3},
        {"win_rate": None, "rest": None},
    ]


def test_text_with_braces_stays_whole(spark):
    df = spark.createDataFrame([(1, 'a}"{\n}', None, None)], SCHEMA)
    assert json.loads(df.select(document(df, ["rest"])).first()[0])["team"] == 'a}"{\n}'


def test_bulk_lines_are_ascii_and_in_pairs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    text = "\n".join(r.value for r in bulk_lines(df, "teams").collect())
    assert text.isascii()
    lines = [json.loads(x) for x in text.split("\n")]
    assert lines[::2] == [{"index": {"_index": "teams"}}] * 3
    assert lines[1]["team"] == "Zürich"


def test_export_replaces_and_limits_files(spark, tmp_path):
    path = tmp_path / "export"
    df = spark.range(0, 1001, 1, 1).withColumnRenamed("id", "game_id")
    write_bulk(df, str(path), "m")
    assert len(list(path.glob("part-*"))) == 1
    assert sorted(r.documents for r in bulk_requests(spark, str(path), "m").collect()) == [1, 500, 500]
    write_bulk(df, str(path), "m", documents_per_file=500)
    files = [f.read_text().splitlines() for f in path.glob("part-*")]
    assert sorted(len(f) for f in files) == [2, 1000, 1000]
    ids = [json.loads(x)["game_id"] for f in files for x in f[1::2]]
    assert sorted(ids) == list(range(1001))


def test_requests_hold_every_pair_once_wherever_files_are_cut(spark, tmp_path):
    path = str(tmp_path / "export")
    df = spark.range(0, 700, 1, 1).selectExpr("id AS game_id", "concat('text \n ', id) AS note")
    write_bulk(df, path, "m")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 997)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        assert read_bulk(spark, path, "m").count() == 700
        bodies = [r.body for r in bulk_requests(spark, path, "m", 7).collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    lines = [json.loads(x) for body in bodies for x in body.splitlines()]
    assert all(len(b.splitlines()) <= 14 for b in bodies)
    assert lines[::2] == [{"index": {"_index": "m"}}] * 700
    assert sorted(x["game_id"] for x in lines[1::2]) == list(range(700))


def test_batches_are_numbered_in_order(spark):
    df = spark.range(0, 1200).selectExpr(
        "id AS game_id", "date_add(DATE'2024-01-01', CAST(id % 7 AS INT)) AS game_date"
    )
    whole = with_batch(df).orderBy("game_id").collect()
    cut = with_batch(df, max_rows=20).orderBy("game_id").collect()
    assert whole == cut
    order = sorted(whole, key=lambda r: (r.game_date, r.game_id))
    assert [r.batch for r in order] == [i // 500 for i in range(1200)]


def test_cut_numbering_reads_few_files(spark):
    """Lanes of 20 rows do not make as many files, tasks and results for the driver."""
    df = spark.range(10_000).selectExpr("id AS game_id", "DATE'2024-01-01' AS game_date")
    cut = with_batch(df, batch_size=500, max_rows=20)
    assert len(cut.inputFiles()) <= 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.game_id, r.batch) for r in cut.collect()} == {(i, i // 500) for i in range(10_000)}
