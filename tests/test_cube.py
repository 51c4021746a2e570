from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leaguelake.plans import cube, dashboard

SCHEMA = (
    "game_id long, game_date date, season int, team_name string, conference string, is_home int, is_win int, "
    "win_rate_last5 double, avg_points_last5 double, rest_days int, schedule_difficulty_next5 float, "
    "home_games_next5 double, away_games_next5 double"
)


def rows(n, seed):
    rng = random.Random(seed)
    maybe = lambda x: None if rng.random() < 0.05 else x
    out = []
    for i in range(n):
        day = dt.date(2023, 11, 1) + dt.timedelta(days=rng.randrange(150))
        team = "hot" if rng.random() < 0.4 else f"t{rng.randrange(6)}"
        out.append((
            i, maybe(day), 2023 + (day.year > 2023), maybe(team), maybe("East" if team < "t3" else "West"),
            maybe(rng.randrange(2)), maybe(rng.randrange(2)), maybe(rng.randrange(6) / 5), maybe(rng.randrange(400, 700) / 5),
            maybe(rng.randrange(5)), maybe(rng.random()), maybe(float(rng.randrange(6))), maybe(float(rng.randrange(6))),
        ))
    return out


@pytest.fixture(scope="module")
def team(spark):
    return spark.createDataFrame(rows(900, 1), SCHEMA).cache()


def answers(source, panels):
    return {name: sorted(map(tuple, panel(source).collect()), key=repr) for name, panel in panels}


DASHBOARD = [(name, getattr(dashboard, name)) for name in cube.PANELS]
FILTERS = [
    {},
    {"start": "2023-12-10", "end": "2024-02-20"},
    {"start": "2024-01-01", "end": "2024-01-31"},
    {"start": "2024-01-05", "end": "2024-01-09"},
    {"start": "2024-02-02"},
    {"end": "2023-12-31", "teams": ["hot", "t1"]},
    {"seasons": [2024], "teams": ["t2", "none"]},
    {"start": "2030-01-01"},
]


@pytest.mark.parametrize("chosen", FILTERS)
def test_panels_equal_those_over_rows(team, chosen):
    made = cube.pick(cube.cells(team), **chosen)
    assert answers(made, cube.PANELS.items()) == answers(dashboard.filtered(team, **chosen), DASHBOARD)


def test_runs_add_up_and_corrections_take_rows_back(spark, team, tmp_path):
    table = str(tmp_path / "cube")
    wrong = team.where("game_id % 3 = 0").withColumn("avg_points_last5", F.lit(7.3)).withColumn("team_name", F.lit("gone"))
    first = team.where("game_id % 3 = 1").unionByName(wrong)
    cube.write_cells(cube.cells(first), table, "2024-01-01")
    second = cube.changes(wrong, team.where("game_id % 3 <> 1"))
    for _ in range(2):  # a repeated run is not added twice
        cube.write_cells(second, table, "2024-01-02")
    made = cube.merged(cube.read_cells(spark, table))
    whole = cube.cells(team)
    assert made.exceptAll(whole).isEmpty() and whole.exceptAll(made).isEmpty()
    assert made.where("team_name = 'gone'").isEmpty()
    early = cube.merged(cube.read_cells(spark, table, "2024-01-01"))
    assert early.where("level = 'month'").agg(F.sum("rows")).first()[0] == first.count()


def test_a_range_takes_whole_months_and_single_days(team):
    picked = cube.pick(cube.cells(team), start="2023-12-30", end="2024-02-01")
    periods = {(r.level, str(r.month) if r.level == "month" else str(r.game_date)) for r in picked.collect()}
    assert periods == {("day", "2023-12-30"), ("day", "2023-12-31"), ("month", "2024-01-01"), ("day", "2024-02-01")}


def test_no_rows_no_cells(team):
    none = cube.cells(team.limit(0))
    assert none.count() == 0
    assert answers(none, [("n", cube.win_rate_by_team)]) == {"n": []}


def test_a_row_that_is_replaced_by_itself_changes_nothing(team):
    assert cube.changes(team, team).isEmpty()


def test_cells_take_one_shuffle(team):
    plan = cube.cells(team)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
