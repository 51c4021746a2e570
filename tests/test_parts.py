from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from test_sources import put, raw_game

from leaguelake.sinks.parts import PART, PartTable
from leaguelake.streaming.games import current_games, current_table, load_new_games

ROWS = "id long, seen int, value string"


def newest():
    return [F.col("seen").desc(), F.col("value").desc()]


def rows_of(table, spark):
    return sorted(map(tuple, table.read(spark).collect()), key=str)


def test_updates_equal_a_dictionary(spark, tmp_path):
    rng, table, want = random.Random(5), PartTable(str(tmp_path / "t"), ("id",), 7), {}
    for update in range(5):
        batch = [(rng.randrange(60), rng.randrange(9), f"v{rng.randrange(99)}") for _ in range(40)]
        batch += [(3, 4, "hot")] * 30  # repeated rows of one key
        table.upsert(spark.createDataFrame(batch, ROWS), newest(), update)
        for row in batch:
            want[row[0]] = max(want.get(row[0], row), row, key=lambda r: r[1:])
        assert rows_of(table, spark) == sorted(want.values(), key=str)


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    table = PartTable(str(tmp_path / "t"), ("id",), 8)
    table.upsert(spark.range(100).selectExpr("id", "1 seen", "'a' value"), newest(), 0)
    before = table.live(spark)
    table.upsert(spark.createDataFrame([(5, 2, "b")], ROWS), newest(), 1)
    after = table.live(spark)
    assert len(before) == 8 and sum(after[p] != before[p] for p in before) == 1
    written = {p.name for p in (tmp_path / "t" / "data" / "update=1").glob(f"{PART}=*")}
    assert len(written) == 1 and table.read(spark).count() == 100


def test_a_repeated_or_broken_update(spark, tmp_path):
    table = PartTable(str(tmp_path / "t"), ("id",), 4)
    table.upsert(spark.createDataFrame([(1, 1, "a"), (None, 1, "n"), (None, 1, "n")], ROWS), newest(), 0)
    first = rows_of(table, spark)
    assert len(first) == 3  # rows without a key are no copies
    update = spark.createDataFrame([(1, 2, "b"), (2, 1, "c"), (None, 1, "m")], ROWS)
    table.upsert(update, newest(), 1)
    once = rows_of(table, spark)
    # the manifest is what makes an update visible
    (tmp_path / "t" / "manifest" / "update=1" / "_SUCCESS").unlink()
    assert rows_of(table, spark) == first
    table.upsert(update, newest(), 1)
    table.upsert(update, newest(), 1)
    assert rows_of(table, spark) == once and len(once) == 5


def test_empty_updates_and_vacated_parts(spark, tmp_path):
    table = PartTable(str(tmp_path / "t"), ("id",), 4)
    nothing = spark.createDataFrame([], ROWS)
    assert table.read(spark) is None
    table.upsert(nothing, newest(), 0)
    assert table.read(spark) is None
    table.upsert(spark.range(20).selectExpr("id", "1 seen", "'a' value"), newest(), 1)
    table.upsert(nothing, newest(), 2)
    assert table.read(spark).count() == 20
    table.replace(table.read(spark).where("id < 0"), set(range(4)), 3)
    assert table.read(spark) is None


def test_vacuum_keeps_what_is_read(spark, tmp_path):
    table = PartTable(str(tmp_path / "t"), ("id",), 4)
    for update in range(4):
        table.upsert(spark.range(30).selectExpr("id", f"{update} seen", "'a' value"), newest(), update)
    want = rows_of(table, spark)
    table.vacuum(spark, keep=1)
    assert rows_of(table, spark) == want and table.updates(spark) == [3]
    assert not list((tmp_path / "t" / "data" / "update=0").glob(f"{PART}=*"))


def test_another_number_of_parts_is_refused(spark, tmp_path):
    PartTable(str(tmp_path / "t"), ("id",), 4).upsert(spark.createDataFrame([(1, 1, "a")], ROWS), newest(), 0)
    with pytest.raises(ValueError, match="4 parts"):
        PartTable(str(tmp_path / "t"), ("id",), 5).read(spark)


def test_stream_keeps_one_copy_of_each_game(spark, tmp_path):
    current = current_table(str(tmp_path / "current"), 4)

    def load():
        paths = [str(tmp_path / n) for n in ("raw", "loads", "offsets")]
        load_new_games(spark, *paths, current=current)
        got = current_games(spark, current)
        ranked = current_games(spark, paths[1])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ranked.select(got.columns).collect()), key=str)
        return {r.game_id: r.home_team_score for r in got.collect()}

    put(tmp_path / "raw" / "dt=2024-11-02" / "a.json", json.dumps({"data": [raw_game(1), raw_game(2), raw_game(2)]}))
    assert load() == {1: 101, 2: 102}
    put(tmp_path / "raw" / "dt=2024-11-03" / "b.json", json.dumps([raw_game(2, home_team_score=7), raw_game(3)]))
    assert load() == {1: 101, 2: 7, 3: 103}
    put(tmp_path / "raw" / "dt=2024-11-01" / "late.json", json.dumps([raw_game(2, home_team_score=1)]))
    assert load() == {1: 101, 2: 7, 3: 103}
    # the last batch's commit is lost, as after a crash
    for file in (tmp_path / "offsets" / "commits").iterdir():
        file.unlink()
    assert load() == {1: 101, 2: 7, 3: 103}
