from __future__ import annotations

import datetime as dt

import pytest
from league import GAMES, GOLDEN, expected_form, expected_strength, random_games
from pyspark.sql import functions as F

from leaguelake.operators import schedule
from leaguelake.operators.dedup import latest_run
from leaguelake.operators.form import prior_cumulative, team_form
from leaguelake.operators.lanes import Timeline, enter
from leaguelake.operators.schedule import next_is_home, schedule_simple, schedule_strength
from leaguelake.operators.sides import TEAM_GAMES, side_split

FORM = [
    "games_played",
    "win_rate",
    "avg_points_for",
    "avg_points_against",
    "win_rate_last5",
    "avg_points_last5",
    "rest_days",
]


def form_by_key(df):
    return {(r.game_id, r.team_id, r.is_home): {c: r[c] for c in FORM} for r in df.collect()}


def assert_same_form(found, expected):
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values), key


# team, game, gp, win_rate, avg_for, avg_against, wr_last5, pts_last5, rest, home5, away5, difficulty
GOLDEN_ROWS = [
    (1, 1, 0, None, None, None, None, None, None, 3, 2, 1.08),
    (1, 2, 1, 1.0, 110.0, 100.0, 0.2, 22.0, 2, 3, 2, 1.08),
    (1, 3, 2, 0.5, 104.5, 102.5, 0.2, 41.8, 1, 2, 3, 1.12),
    (1, 4, 3, 0.666667, 109.666667, 106.666667, 0.4, 65.8, 4, 1, 4, 1.16),
    (1, 5, 4, 0.5, 104.75, 105.25, 0.4, 83.8, 2, 1, 4, 1.16),
    (1, 6, 5, 0.6, 103.2, 101.8, 0.6, 103.2, 1, 0, 5, 1.2),
    (1, 7, 6, 0.666667, 107.666667, 105.666667, 0.6, 107.2, 4, 0, 5, 1.2),
    (2, 1, 0, None, None, None, None, None, None, 2, 3, 1.12),
    (2, 2, 1, 0.0, 100.0, 110.0, 0.0, 20.0, 2, 2, 3, 1.12),
    (2, 3, 2, 0.5, 102.5, 104.5, 0.2, 41.0, 1, 2, 3, 1.12),
    (2, 4, 3, 0.333333, 106.666667, 109.666667, 0.2, 64.0, 4, 2, 3, 1.12),
    (2, 5, 4, 0.5, 105.25, 104.75, 0.4, 84.2, 2, 1, 4, 1.16),
    (2, 6, 5, 0.4, 101.8, 103.2, 0.4, 101.8, 1, 1, 4, 1.16),
    (2, 7, 6, 0.333333, 105.666667, 107.666667, 0.4, 106.8, 4, 0, 5, 1.2),
]


@pytest.mark.parametrize("max_rows", [None, 2])
def test_golden_season(spark, max_rows):
    sides = side_split(spark.createDataFrame(GOLDEN, GAMES))
    form = team_form(sides, max_rows=max_rows)
    rows = schedule_simple(form, max_rows=max_rows).orderBy("team_id", "game_id").collect()
    found = [
        (r.team_id, r.game_id, *[r[c] for c in FORM], r.home_games_next5, r.away_games_next5,
         r.schedule_difficulty_next5)
        for r in rows
    ]
    for got, want in zip(found, GOLDEN_ROWS, strict=True):
        assert [x is None for x in got] == [x is None for x in want]
        assert [x for x in got if x is not None] == pytest.approx(
            [x for x in want if x is not None], abs=1e-6
        )


@pytest.mark.parametrize(
    ("skew", "max_rows"),
    [
        ({}, None),
        ({}, 7),
        ({"hot_team": 0.4}, 50),
        ({"hot_day": 0.4}, 10),
        ({"hot_team": 0.4, "hot_day": 0.4}, 20),
        ({"null_team": 0.4}, 30),
        ({"hot_day": 0.5, "ids": lambda i: 10**17 if i == 3 else i * i}, 10),
        ({"hot_day": 0.5, "ids": lambda i: -i}, 10),
    ],
)
def test_form_equals_plain_python(spark, skew, max_rows):
    games = random_games(400, 6, 60, seed=11, **skew)
    df = spark.createDataFrame(games, GAMES)
    assert_same_form(
        form_by_key(team_form(side_split(df), max_rows=max_rows)), expected_form(games)
    )


@pytest.mark.parametrize("within", [{}, {"FORMS_IN_TASK": 0}, {"FORMS_IN_DAY": 1}])
def test_strength_is_the_same_however_forms_are_found(spark, monkeypatch, within):
    """Forms held by day, and forms joined with every coming game."""
    for name, value in within.items():
        monkeypatch.setattr(schedule, name, value)
    games = random_games(150, 5, 40, seed=6, hot_team=0.3)
    rows = schedule.form_and_strength(side_split(spark.createDataFrame(games, GAMES)), (2, 5))
    assert ("posexplode" in rows._jdf.queryExecution().toString()) == bool(within)
    assert not [c for c in rows.columns if c.startswith("__")]
    for h in (2, 5):
        names = [f"{n}_games_next{h}" for n in ("home", "away", "b2b")] + [f"schedule_difficulty_next{h}"]
        found = {(r.game_id, r.team_id): tuple(r[c] for c in names) for r in rows.collect()}
        expected = {k[:2]: v for k, v in expected_strength(games, h).items()}
        assert found.keys() == expected.keys()
        for key, want in expected.items():
            assert found[key][:3] == want[:3] and found[key][3] == pytest.approx(want[3]), key


@pytest.mark.parametrize("horizon", [5, 10])
@pytest.mark.parametrize("max_rows", [None, 9])
def test_strength_equals_plain_python(spark, horizon, max_rows):
    games = random_games(150, 5, 40, seed=5, hot_team=0.3, hot_day=0.2)
    # A team can meet itself on no day, so (game, team) names a row.
    sides = side_split(spark.createDataFrame(games, GAMES))
    found = {
        (r.game_id, r.team_id): (r[3], r[4], r[5], r[6])
        for r in schedule_strength(sides, horizon, max_rows=max_rows).collect()
    }
    expected = {k[:2]: v for k, v in expected_strength(games, horizon).items()}
    assert found.keys() == expected.keys()
    for key, want in expected.items():
        assert found[key][:3] == want[:3], key
        assert found[key][3] == pytest.approx(want[3]), key


def test_next_is_home_looks_across_lanes(spark):
    sides = side_split(spark.createDataFrame(random_games(200, 4, 30, seed=2), GAMES))
    order = ["game_id", "team_id"]
    whole = next_is_home(sides).orderBy(*order)
    cut = next_is_home(sides, max_rows=3).orderBy(*order)
    assert whole.collect() == cut.select(*whole.columns).collect()


def test_lanes_are_bounded_by_the_limit(spark):
    """A team with 40 % of the rows and a day with 40 % of the rows end up in small lanes."""
    games = random_games(4000, 10, 50, seed=3, hot_team=0.4, hot_day=0.4)
    lanes = enter(
        side_split(spark.createDataFrame(games, GAMES)), TEAM_GAMES, ["is_win"], 5, 5, max_rows=100
    )
    assert lanes.split
    sizes = lanes.rows.groupBy("team_id", "__lane").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3 * 100 + 11


@pytest.mark.parametrize(
    ("position", "limit"),
    [
        ("CASE WHEN id % 10 = 0 THEN id ELSE 3600 END", 200),  # nine in ten at the same second
        ("CAST(exp(id / 2000) AS LONG)", 50),
        ("CAST(id AS LONG)", 50),
    ],
)
def test_lanes_are_bounded_however_rows_crowd(spark, position, limit):
    """One entity, one day, 20,000 rows."""
    rows = spark.range(20_000).selectExpr("'a' AS who", "DATE'2024-01-01' AS day", "id", f"{position} AS at")
    lanes = enter(rows, Timeline(("who",), "day", ("at", "id")), before=5, max_rows=limit)
    sizes = lanes.rows.groupBy("__lane").count().agg(F.max("count")).first()[0]
    assert sizes <= 3 * limit + 6


def test_ranked_values_are_bounded_however_they_crowd(spark):
    rows = spark.range(20_000).selectExpr("'a' AS who", "exp(id / 1000.0) AS value")
    lanes = enter(rows, Timeline(("who",), "value"), max_rows=50)
    assert lanes.rows.groupBy("__lane").count().agg(F.max("count")).first()[0] <= 3 * 50 + 1


def test_a_small_limit_makes_many_lanes_but_few_tasks(spark):
    """Partitions follow the session's shuffle partitions, not the rows over the limit."""
    rows = spark.range(20_000).selectExpr("id % 3 AS who", "DATE'2024-01-01' AS day", "id")
    lanes = enter(rows, Timeline(("who",), "day", ("id",)), before=5, max_rows=20)
    assert lanes.rows.where(lanes.is_own).select("__lane").distinct().count() >= 20_000 / 20
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(lanes.rows.inputFiles()) <= 3 * usual  # the rows and the table of cut entities


def test_lanes_agree_on_the_order_of_rows_alike(spark):
    """300 rows of one entity and moment, cut into lanes: totals, numbers and last rows are of one order."""
    rows = spark.range(300).selectExpr("'a' AS who", "DATE'2024-01-01' AS day", "id", "id * id AS v")
    lanes = enter(rows, Timeline(("who",), "day"), ["v"], before=5, max_rows=7)
    assert lanes.split
    columns = [lanes.ordinal().alias("at"), lanes.prior_sum("v").alias("cum"), lanes.last_sum(F.col("v"), 5).alias("last")]
    found = lanes.leave(lanes.rows.select("*", *columns)).orderBy("at").collect()
    assert sorted(r.id for r in found) == list(range(300)) and found[0].asDict().keys() == {*rows.columns, "at", "cum", "last"}
    for i, r in enumerate(found):
        before = [x.v for x in found[:i]]
        assert (r.at, r.cum, r["last"]) == (i + 1, sum(before) if i else None, sum(before[-5:]) if i else None)


def test_few_entities_are_cut(spark):
    """A lane ends in at most one entity, so cuts are as many as lanes."""
    games = random_games(600, 40, 50, seed=4, hot_team=0.5)
    lanes = enter(side_split(spark.createDataFrame(games, GAMES)), TEAM_GAMES, before=5, max_rows=150)
    cut = lanes.rows.groupBy("team_id").agg(F.countDistinct("__lane").alias("n")).where("n > 1")
    found = [r.team_id for r in cut.collect()]
    assert 0 in found and len(found) <= 1200 // 150


def test_copies_of_games_change_nothing(spark):
    """Two runs with the same games give the features of one run."""
    games = random_games(200, 6, 40, seed=8)
    df = spark.createDataFrame(games, GAMES)
    runs = df.withColumn("dt", F.lit("2024-01-01")).unionByName(df.withColumn("dt", F.lit("2024-01-02")))
    once = latest_run(runs, ["game_id"]).drop("dt")
    assert_same_form(form_by_key(team_form(side_split(once))), expected_form(games))


def test_a_score_changes_no_earlier_feature(spark):
    games = random_games(200, 6, 40, seed=9)
    games.sort(key=lambda g: (g[1], g[0]))
    changed = list(games)
    g = changed[100]
    changed[100] = (*g[:5], 200, 10, g[7])
    moment = (g[1], g[0])
    before, after = (
        form_by_key(team_form(side_split(spark.createDataFrame(x, GAMES)))) for x in (games, changed)
    )
    when = {x[0]: (x[1], x[0]) for x in games}
    early = [k for k in before if when[k[0]] <= moment]
    assert early and all(before[k] == after[k] for k in early)
    assert any(before[k] != after[k] for k in before)


def test_invariants(spark):
    games = spark.createDataFrame(random_games(300, 6, 40, seed=10), GAMES)
    form = team_form(side_split(games))
    per_game = form.groupBy("game_id").agg(
        F.count("*").alias("n"),
        F.sum("is_win").alias("wins"),
        F.sum("points_for").alias("f"),
        F.sum("points_against").alias("a"),
    )
    assert per_game.where("n <> 2 or wins > 1 or not (f <=> a)").isEmpty()
    first = form.where("game_number = 1")
    assert first.where("coalesce(win_rate, win_rate_last5, rest_days) is not null").isEmpty()


def test_denominators(spark):
    sides = side_split(spark.createDataFrame(GOLDEN, GAMES))
    actual = {
        r.game_id: r.avg_points_last5
        for r in team_form(sides, denominator="actual").where("team_id = 1").collect()
    }
    assert actual[1] is None
    assert actual[2] == 110.0 and actual[3] == 104.5
    assert actual[7] == pytest.approx((99 + 120 + 90 + 97 + 130) / 5)
    with pytest.raises(ValueError):
        team_form(sides, denominator="other")


def test_season_in_the_entity_starts_afresh(spark):
    rows = [(*g[:2], 2024 + (g[0] > 4), *g[3:]) for g in GOLDEN]
    line = Timeline(("team_id", "season"), "game_date", ("game_id",))
    form = team_form(side_split(spark.createDataFrame(rows, GAMES)), line)
    played = {(r.team_id, r.game_id): r.games_played for r in form.collect()}
    assert played[(1, 4)] == 3 and played[(1, 5)] == 0 and played[(2, 7)] == 2


def test_other_timelines(spark):
    """Any entity, any order: timestamps within a day, several rows at the same moment."""
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t.date(), t + dt.timedelta(minutes=i // 2), i, i * 10) for i in range(50)]
    df = spark.createDataFrame(rows, "who string, day date, ts timestamp, id long, v long")
    line = Timeline(("who",), "day", ("ts", "id"))
    cut = prior_cumulative(df, line, ["v"], max_rows=4).orderBy("id").collect()
    assert [r.v_cum for r in cut[1:]] == [sum(range(0, i * 10, 10)) for i in range(1, 50)]
    assert cut[0].v_cum is None and [r.games_played for r in cut] == list(range(50))
