from __future__ import annotations

import datetime as dt
import random

import pytest
from league import GAMES, random_games

from leaguelake.operators.form import team_form
from leaguelake.operators.sides import side_split
from leaguelake.plans.form_table import MONTH, FormTable


def expected(spark, games):
    """The form of all games at once."""
    return team_form(side_split(spark.createDataFrame(games, GAMES)))


def same(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [sorted(map(str, map(tuple, df.select(columns).collect()))) for df in (got, want)]
    assert rows[0] == rows[1]


def moved(game, days=0, scores=None, home=None):
    game_id, day, season, h, v, hs, vs, status = game
    hs, vs = scores or (hs, vs)
    return (game_id, day and day + dt.timedelta(days=days), season, home or h, v, hs, vs, status)


@pytest.mark.parametrize("max_rows", [20, None])
def test_updates_equal_computing_everything(spark, tmp_path, max_rows):
    """New days, corrected scores, moved days, other teams, missing teams and days, one hot team."""
    rng = random.Random(8)
    games = random_games(150, 6, 200, 3, hot_team=0.4, null_team=0.05)
    games.sort(key=lambda g: g[1])
    games[7] = (games[7][0], None, *games[7][2:])
    table, state = FormTable(str(tmp_path / "form"), 4), {}
    for number, (lo, hi) in enumerate([(0, 90), (90, 120), (120, 150)]):
        batch = games[lo:hi]
        known = sorted(state.values(), key=str)
        if known:
            old = rng.sample(known, 4)
            batch = batch + [
                moved(old[0], scores=(1, 200)), moved(old[1], days=70), moved(old[2], days=-70), moved(old[3], home=9)
            ]
        table.update(spark.createDataFrame(batch, GAMES), number, max_rows)
        state.update({g[0]: g for g in batch})
        same(table.read(spark), expected(spark, list(state.values())))


def test_a_new_day_reads_and_writes_the_suffix_only(spark, tmp_path):
    days = [dt.date(2024, m, d) for m in range(1, 10) for d in (3, 9)]
    games = [(i, day, 2024, 1 + i % 3, 4 + i % 2, 100 + i, 99, "final") for i, day in enumerate(days)]
    table = FormTable(str(tmp_path / "form"), 32)
    table.update(spark.createDataFrame(games, GAMES), 1)
    late = (99, dt.date(2024, 9, 20), 2024, 1, 4, 90, 91, "final")
    table.update(spark.createDataFrame([late], GAMES), 2)
    written = spark.read.parquet(str(tmp_path / "form" / "rows" / "data" / "update=2"))
    assert {str(r[MONTH]) for r in written.collect()} <= {"2024-09-01"} or written.count() < len(games)
    same(table.read(spark), expected(spark, [*games, late]))


def test_a_broken_update_is_repeated(spark, tmp_path):
    games = random_games(60, 4, 90, 4)
    table = FormTable(str(tmp_path / "form"), 4)
    table.update(spark.createDataFrame(games[:40], GAMES), 1)
    batch = spark.createDataFrame([*games[40:], moved(games[0], days=40)], GAMES)
    table.update(batch, 2)
    for name in ("games", "marks"):  # only the rows were replaced before it broke off
        (tmp_path / "form" / name / "manifest" / "update=2" / "_SUCCESS").unlink()
    table.update(batch, 2)
    same(table.read(spark), expected(spark, [moved(games[0], days=40), *games[1:]]))


def test_no_games(spark, tmp_path):
    table = FormTable(str(tmp_path / "form"), 4)
    table.update(spark.createDataFrame([], GAMES), 1)
    with pytest.raises(RuntimeError, match="no game"):
        table.read(spark)
