from __future__ import annotations

import json

from test_sources import put, raw_game

from leaguelake.streaming.games import current_games, load_new_games


def load(spark, tmp_path, **more):
    load_new_games(
        spark, str(tmp_path / "raw"), str(tmp_path / "loads"), str(tmp_path / "offsets"), **more
    )
    return {r.game_id: r.home_team_score for r in current_games(spark, str(tmp_path / "loads")).collect()}


def test_only_new_files_are_loaded_and_later_runs_win(spark, tmp_path):
    put(tmp_path / "raw" / "dt=2024-11-01" / "a.json", json.dumps({"data": [raw_game(1), raw_game(2)]}))
    assert load(spark, tmp_path) == {1: 101, 2: 102}
    # An earlier file changed behind the stream's back is not read again.
    first = list((tmp_path / "loads").glob("load=0/*.parquet"))
    put(tmp_path / "raw" / "dt=2024-11-02" / "b.json", json.dumps([raw_game(2, home_team_score=7), raw_game(3)]))
    assert load(spark, tmp_path) == {1: 101, 2: 7, 3: 103}
    assert list((tmp_path / "loads").glob("load=0/*.parquet")) == first
    assert load(spark, tmp_path) == {1: 101, 2: 7, 3: 103}
    assert len(list((tmp_path / "loads").glob("load=*"))) == 2


def test_unreadable_rows_are_set_aside(spark, tmp_path):
    folder = tmp_path / "raw" / "dt=2024-11-01"
    good = json.dumps({"data": [raw_game(1), raw_game("x"), raw_game(None)]})
    put(folder / "a.json", good + "\n" + good[:100])
    assert load(spark, tmp_path) == {1: 101}
    aside = spark.read.parquet(str(tmp_path / "loads-quarantine")).collect()
    assert sorted(r.reason for r in aside) == ["no id", "no id", "unreadable payload"]


def test_a_late_file_of_an_older_run_does_not_win(spark, tmp_path):
    put(tmp_path / "raw" / "dt=2024-11-02" / "a.json", json.dumps([raw_game(1, home_team_score=2)]))
    load(spark, tmp_path)
    put(tmp_path / "raw" / "dt=2024-11-01" / "late.json", json.dumps([raw_game(1, home_team_score=1)]))
    assert load(spark, tmp_path) == {1: 2}


def test_many_small_batches_equal_one(spark, tmp_path):
    for i in range(6):
        put(
            tmp_path / "raw" / "dt=2024-11-01" / f"{i}.json",
            json.dumps({"data": [raw_game(i), raw_game(i + 1)]}),
        )
    assert load(spark, tmp_path, files_per_batch=2) == {i: 100 + i for i in range(7)}


def test_a_repeated_batch_leaves_the_same_rows(spark, tmp_path):
    """The commit of the last batch is lost, as after a crash between write and commit."""
    put(tmp_path / "raw" / "dt=2024-11-01" / "a.json", json.dumps([raw_game(1), raw_game(1), raw_game(2)]))
    before = load(spark, tmp_path)
    for file in (tmp_path / "offsets" / "commits").iterdir():
        file.unlink()
    assert load(spark, tmp_path) == before
    assert spark.read.parquet(str(tmp_path / "loads")).count() == 2
