from __future__ import annotations

import datetime as dt
import json

import pytest
from league import GAMES, random_games
from pyspark.sql import functions as F

from leaguelake.functions import beats, difference_or_zero, iso_date, name_key, ratio, whole_number
from leaguelake.layout import LakeLayout
from leaguelake.operators.dedup import latest_run
from leaguelake.session import SETTINGS, object_store
from leaguelake.sinks.state import write_state
from leaguelake.sources import incremental, lake, raw


def raw_game(i, date="2024-10-22T00:00:00.000Z", **more):
    game = {
        "id": i,
        "date": date,
        "season": 2024,
        "status": "Final",
        "home_team": {"id": 1, "full_name": "One"},
        "visitor_team": {"id": 2},
        "home_team_score": 100 + (i if isinstance(i, int) else 0),
        "visitor_team_score": 90,
    }
    return {**game, **more}


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("multi_line", [True, False])
def test_wrapped_and_bare_payloads_mix(spark, tmp_path, multi_line):
    indent = 2 if multi_line else None
    put(tmp_path / "a.json", json.dumps({"data": [raw_game(1), raw_game(2)], "meta": {}}, indent=indent))
    put(tmp_path / "b.json", json.dumps([raw_game(3), raw_game(4)], indent=indent))
    put(tmp_path / "c.json", json.dumps({"data": [], "meta": {"next_cursor": None}}, indent=indent))
    put(tmp_path / "d.json", json.dumps({"data": None}, indent=indent))
    assert ids(raw.read_games(spark, str(tmp_path), multi_line)) == [1, 2, 3, 4]


def test_runs_keep_their_date_and_the_latest_copy_wins(spark, tmp_path):
    put(tmp_path / "dt=2024-11-01" / "games.json", json.dumps([raw_game(1), raw_game(2)]))
    put(
        tmp_path / "dt=2024-11-02" / "games.json",
        json.dumps({"data": [raw_game(2, home_team_score=7), raw_game(3)]}),
    )
    games = latest_run(raw.format_games(raw.read_games(spark, str(tmp_path))), ["game_id"])
    found = {r.game_id: (r.home_team_score, r.dt) for r in games.collect()}
    assert found == {
        1: (101, dt.date(2024, 11, 1)),
        2: (7, dt.date(2024, 11, 2)),
        3: (103, dt.date(2024, 11, 2)),
    }


def test_unreadable_values_become_null(spark, tmp_path):
    bad = raw_game(1, date="soon", season="x", home_team_score="n/a", home_team=None)
    put(tmp_path / "a.json", json.dumps([bad, raw_game(2)]))
    rows = raw.format_games(raw.read_games(spark, str(tmp_path))).orderBy("game_id").collect()
    assert tuple(rows[0]) == (1, None, None, None, 2, None, 90, "final")
    assert tuple(rows[1]) == (2, dt.date(2024, 10, 22), 2024, 1, 2, 102, 90, "final")


def test_teams_and_venues(spark, tmp_path):
    team = {"id": 5, "full_name": "L.A. Stars 76", "city": "L.A.", "abbreviation": "LAS",
            "conference": "West", "division": "Pacific", "extra": 1}
    venue = {"idTeam": "9", "strTeam": "la-stars (76)", "strStadium": "Dome", "strLocation": "L.A.",
             "intStadiumCapacity": "n/a", "strWebsite": "w", "strBadge": None}
    put(tmp_path / "t" / "teams.json", json.dumps({"data": [team]}, indent=1))
    put(tmp_path / "v" / "teams.json", json.dumps({"teams": [venue]}, indent=1))
    teams = raw.format_teams(raw.read_teams(spark, str(tmp_path / "t"), multi_line=True)).first()
    venues = raw.format_venues(raw.read_venues(spark, str(tmp_path / "v"), multi_line=True)).first()
    assert tuple(teams) == (5, "L.A. Stars 76", "lastars76", "L.A.", "LAS", "West", "Pacific")
    assert tuple(venues) == ("9", "la-stars (76)", "lastars76", "Dome", "L.A.", None, "w", None)


def test_scalars(spark):
    df = spark.createDataFrame([(None, 1, "2024-02-30"), (3, 2, "2024-02-29T10:00:00Z")], "a int, b int, s string")
    row = df.select(
        F.collect_list(beats(F.col("a"), F.col("b"))),
        F.array_agg(F.coalesce(difference_or_zero(F.col("a"), F.col("b")), F.lit(-9.0))),
        F.max(iso_date(F.col("s"))),
        F.max(ratio(F.lit(1), F.lit(0))),
        F.max(whole_number(F.lit(" 12 "))),
        F.max(name_key(F.lit("  Éa-b_9! "))),
    ).first()
    assert row[0] == [0, 1] and row[1] == [0.0, 1.0]
    assert row[2] == dt.date(2024, 2, 29) and row[3] is None and row[4] == 12 and row[5] == "ab9"


def test_a_rerun_replaces_only_its_run(spark, tmp_path):
    table = str(tmp_path / "games")
    games = spark.createDataFrame(random_games(30, 4, 10, seed=1), GAMES)
    lake.write_run(games, table, "2024-01-01")
    lake.write_run(games.limit(10), table, "2024-01-02")
    lake.write_run(games.limit(20), table, "2024-01-02")
    assert lake.read_runs(spark, table).count() == 50
    assert lake.read_run(spark, table, "2024-01-01").count() == 30
    latest = lake.read_latest_run(spark, table)
    assert latest.count() == 20 and "dt" not in latest.columns


def test_one_run_reads_one_directory(spark, tmp_path):
    table = str(tmp_path / "games")
    games = spark.createDataFrame(random_games(30, 4, 10, seed=1), GAMES)
    for day in ("2024-01-01", "2024-01-02"):
        lake.write_run(games, table, day)
    plan = lake.read_run(spark, table, "2024-01-02").select("game_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text
    assert "ReadSchema: struct<game_id:bigint>" in text
    assert len(plan.inputFiles()) <= len(lake.read_runs(spark, table).inputFiles())


def test_state_moves_only_forward_with_data(spark, tmp_path):
    path = str(tmp_path / "state")
    assert incremental.read_state(spark, path) is None
    records = spark.createDataFrame([("2024-01-05T00:00Z",), ("2024-01-07T00:00Z",)], "date string")
    write_state(incremental.high_water_mark(records), path, "2024-01-08")
    write_state(incremental.high_water_mark(records.limit(0)), path, "2024-01-09")
    assert incremental.read_state(spark, path) == "2024-01-07"
    games = spark.createDataFrame(random_games(100, 4, 20, seed=1), GAMES)
    days = incremental.incremental_slice(games, "2024-01-07").agg(F.min("game_date")).first()[0]
    assert days > dt.date(2024, 1, 7)
    assert incremental.incremental_slice(games, None).count() == 100


def test_guard(spark):
    games = spark.createDataFrame([], GAMES)
    with pytest.raises(RuntimeError):
        incremental.guard_nonempty(games, "games")
    assert incremental.guard_nonempty(games, "games", incremental=True) is games


def test_source_filters(spark):
    games = spark.createDataFrame(random_games(100, 4, 20, seed=1), GAMES)
    assert incremental.in_seasons(games, 2022, 2023).isEmpty()
    assert incremental.in_seasons(games, 2023, 2025).count() == 100
    early = incremental.in_dates(games, end="2024-01-10").count()
    late = incremental.in_dates(games, start="2024-01-11").count()
    assert early + late == 100 and early and late


def test_layout_and_settings():
    lake_layout = LakeLayout("s3a://bucket/")
    assert lake_layout.run("raw", "api", "games", "2024-01-01") == "s3a://bucket/raw/api/games/dt=2024-01-01"
    assert SETTINGS["spark.sql.adaptive.enabled"] == "true"
    store = object_store("http://store:9000", "key", "secret")
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert store["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def _checked(spark, folder, payloads, read, multi_line=False):
    folder.mkdir(parents=True)
    for i, text in enumerate(payloads):
        (folder / f"p{i}.json").write_text(text)
    return read(spark, str(folder), multi_line).collect()


def test_no_payload_of_any_kind_is_lost(spark, tmp_path):
    """Whole, cut off, mistyped and empty pages of games, teams and venues: rows in = rows out + set aside."""
    kinds = {
        "games": (raw.read_games_checked, "data", lambda i: {"id": i, "date": "2024-01-01", "home_team": {"id": 1}, "visitor_team": {"id": 2}}),
        "teams": (raw.read_teams_checked, "data", lambda i: {"id": i, "full_name": f"Team {i}"}),
        "venues": (raw.read_venues_checked, "teams", lambda i: {"idTeam": str(i), "strTeam": f"Venue {i}"}),
    }
    for name, (read, wrapper, one) in kinds.items():
        key = "idTeam" if name == "venues" else "id"
        page = json.dumps({wrapper: [one(1), one(2)]})
        nameless = {k: v for k, v in one(9).items() if k != key}
        payloads = [page, page[:-5], json.dumps([one(3), nameless, one(4) | {key: None}]), json.dumps(one(5)), '{"error": 1}', "[]", "7", "", "null"]
        for multi_line in (False, True):
            rows = _checked(spark, tmp_path / f"{name}{multi_line}", payloads, read, multi_line)
            good = sorted(int(r[key]) for r in rows if r.reason is None)
            aside = sorted((r.reason, r.raw_text) for r in rows if r.reason is not None)
            assert good == [1, 2, 3, 5]
            assert [r for r, _ in aside] == ["no id"] * 2 + ["no records"] * 3 + ["unreadable payload"]
            assert aside[-1][1] == page[:-5] and {t for _, t in aside[2:5]} == {'{"error": 1}', "7", "null"}
            assert json.loads(aside[0][1]) in (nameless, one(4) | {key: None})
            assert all(r.raw_text is None for r in rows if r.reason is None)


def test_one_wrong_field_costs_no_other(spark, tmp_path):
    given = [
        {"id": 5, "status": "Final", "home_team": 7, "visitor_team": {"id": 2}},
        {"id": 6, "home_team": {"id": "x"}, "visitor_team": {"id": 3}},
        {"id": 7, "home_team": None, "visitor_team": {"id": "4", "name": "n"}, "season": 2024, "home_team_score": "12"},
        {"id": 8, "home_team": [1]},
        {"id": "9", "home_team": {}},
    ]
    rows = {r.id: r for r in _checked(spark, tmp_path / "g", [json.dumps(given)], raw.read_games_checked)}
    assert {i: r.reason for i, r in rows.items()} == {5: "unreadable field: home_team", 6: "unreadable field: home_team", 7: None, 8: "unreadable field: home_team", 9: None}
    assert rows[5].status == "Final" and rows[5].visitor_team.id == 2 and json.loads(rows[5].raw_text) == given[0]
    assert rows[7].visitor_team.id == 4 and (rows[7].season, rows[7].home_team_score) == ("2024", "12")


def test_documents_beyond_sixteen_megabytes(spark, tmp_path):
    many = [{"id": i, "status": "x" * 1000, "home_team": {"id": 1}} for i in range(20_000)]
    rows = raw.read_games_checked(spark, _put(tmp_path / "big", json.dumps({"data": many})), multi_line=True)
    assert rows.groupBy("reason").count().collect() == [(None, 20_000)]


def _put(folder, text):
    folder.mkdir(parents=True)
    (folder / "big.json").write_text(text)
    return str(folder)
