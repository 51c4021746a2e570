from __future__ import annotations

import json
from pathlib import Path

import daily
import pytest
from league import expected_form, random_games
from test_sources import put

from leaguelake.layout import LakeLayout
from leaguelake.plans import cube, dashboard, jobs
from leaguelake.sinks.changes import applied_all
from leaguelake.sinks.documents import read_bulk
from leaguelake.sources import lake
from leaguelake.sources.incremental import read_state
from pyspark.ml import PipelineModel

CUTOFF = "2024-02-15"
TEAMS = [
    {"id": i, "full_name": f"Team {i}", "city": "c", "abbreviation": f"T{i}",
     "conference": "East" if i % 2 else "West", "division": "d"}
    for i in range(6)
]
VENUES = [
    {"idTeam": str(i), "strTeam": f"TEAM-{i}!", "strStadium": f"s{i}", "strLocation": "l",
     "intStadiumCapacity": "n/a" if i else "20000", "strWebsite": None, "strBadge": None}
    for i in range(4)
]


def as_raw(game):
    game_id, day, season, home, visitor, hs, vs, status = game
    return {"id": game_id, "date": f"{day}T00:00:00.000Z", "season": season, "status": status.title(),
            "home_team": {"id": home}, "visitor_team": {"id": visitor},
            "home_team_score": hs, "visitor_team_score": vs}


def land(root, run, games, dims=True, wrapped=True):
    base = root / "raw"
    records = [as_raw(g) for g in games]
    body = {"data": records, "meta": {}} if wrapped else records
    put(base / jobs.GAMES / "games" / f"dt={run}" / "games.json", json.dumps(body, indent=1))
    if dims:
        put(base / jobs.GAMES / "teams" / f"dt={run}" / "teams.json", json.dumps(TEAMS, indent=1))
        put(base / jobs.VENUES / "teams" / f"dt={run}" / "teams.json", json.dumps({"teams": VENUES}, indent=1))


@pytest.fixture(scope="module")
def games():
    return random_games(300, 6, 80, seed=31)


def forms(spark, layout, run):
    return {
        (r.game_id, r.team_id, r.is_home): (r.win_rate, r.avg_points_last5, r.rest_days)
        for r in jobs.team_view(spark, layout, run).collect()
    }


def expected(games):
    return {
        k: (v["win_rate"], v["avg_points_last5"], v["rest_days"])
        for k, v in expected_form(games).items()
    }


def same(found, wanted):
    assert found.keys() == wanted.keys()
    return all(list(found[k]) == pytest.approx(list(wanted[k])) for k in wanted)


def test_a_full_run_end_to_end(spark, tmp_path, games):
    run, layout = "2024-06-01", LakeLayout(str(tmp_path))
    land(tmp_path, run, games + games[:50])
    scores = jobs.run(spark, layout, run, CUTOFF, multi_line=True)
    assert set(scores) == {"train_auc", "train_accuracy", "test_auc", "test_accuracy"}
    assert same(forms(spark, layout, run), expected(games))
    cells = jobs.team_cube(spark, layout, run)
    panel = dashboard.team_ranking(jobs.team_view(spark, layout, run))
    assert cube.team_ranking(cube.pick(cells)).collect() == panel.collect()
    matches = lake.read_run(spark, layout.table("combined", jobs.GAMES, "match_metrics"), run)
    assert matches.count() == 300 and len(matches.columns) == 28
    team = jobs.team_view(spark, layout, run)
    assert len(team.columns) == 20
    assert team.select("schedule_difficulty_next5", "home_games_next5").distinct().collect() == [(1.0, 2.5)]
    predicted = jobs.match_view(spark, layout, run)
    assert predicted.where("season is null or game_date < DATE'2024-02-15'").isEmpty()
    PipelineModel.load(layout.run("models", jobs.GAMES, "home_win", run))
    assert read_state(spark, layout.state(jobs.STATE)) == str(max(g[1] for g in games))
    lines = spark.read.text(layout.table("export", jobs.GAMES, "team_metrics"))
    assert lines.count() == 2 * 600
    assert lines.where("value like '%\"home_games_next5\":2.5%'").count() == 600
    scratch = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "leaguelake"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    again = jobs.run(spark, layout, run, CUTOFF, multi_line=True, train_on_all=True)
    assert again == scores
    assert (set(scratch.iterdir()) if scratch.exists() else set()) == before
    assert spark.read.text(layout.table("export", jobs.GAMES, "team_metrics")).count() == 1200


def test_overlapping_runs_leak_nothing(spark, tmp_path, games):
    """Every game lands twice; with copies in the windows a game would see its own result."""
    layout = LakeLayout(str(tmp_path))
    land(tmp_path, "2024-06-01", games)
    land(tmp_path, "2024-06-02", games, wrapped=False)
    for run in ("2024-06-01", "2024-06-02"):
        jobs.format_games(spark, layout, run, "all_runs", multi_line=True)
        jobs.format_dimensions(spark, layout, run, multi_line=True)
    jobs.combine_layer(spark, layout, "2024-06-02", all_runs=True)
    assert same(forms(spark, layout, "2024-06-02"), expected(games))


def test_incremental_runs(spark, tmp_path, games):
    layout = LakeLayout(str(tmp_path))
    ordered = sorted(games, key=lambda g: g[1])
    middle = ordered[150][1]
    early = [g for g in games if g[1] <= middle]
    land(tmp_path, "2024-06-01", early)
    land(tmp_path, "2024-06-02", games, dims=False)
    for run in ("2024-06-01", "2024-06-02", "2024-06-03"):
        jobs.format_games(spark, layout, run, "incremental", multi_line=True)
        jobs.format_dimensions(spark, layout, run, required=False, multi_line=True)
    table = layout.table("formatted", jobs.GAMES, "games")
    assert lake.read_run(spark, table, "2024-06-01").count() == len(early)
    assert lake.read_run(spark, table, "2024-06-02").count() == len(games) - len(early)
    jobs.combine_layer(spark, layout, "2024-06-03", all_runs=True)
    assert same(forms(spark, layout, "2024-06-03"), expected(games))
    names = jobs.team_view(spark, layout, "2024-06-03").where("team_name is null")
    assert names.isEmpty()


def test_schedule_kinds(spark, tmp_path, games):
    layout, run = LakeLayout(str(tmp_path)), "2024-06-01"
    land(tmp_path, run, games)
    jobs.format_games(spark, layout, run, multi_line=True)
    jobs.format_dimensions(spark, layout, run, multi_line=True)
    for kind in ("simple", "strength"):
        jobs.combine_layer(spark, layout, run, schedule=kind)
        team = jobs.team_view(spark, layout, run)
        assert team.count() == 600
        assert team.select("home_games_next5").distinct().count() > 2
    with pytest.raises(ValueError):
        jobs.combine_layer(spark, layout, run, schedule="other")
    jobs.combine_layer(spark, layout, run, status="postponed")
    assert jobs.team_view(spark, layout, run).isEmpty()


def test_a_filtered_load_leaves_the_rest_to_an_incremental_one(spark, tmp_path, games):
    layout = LakeLayout(str(tmp_path))
    land(tmp_path, "2024-06-01", games)
    land(tmp_path, "2024-06-02", games, dims=False)
    middle = str(sorted(g[1] for g in games)[100])
    jobs.format_games(spark, layout, "2024-06-01", dates=(None, middle), multi_line=True)
    assert read_state(spark, layout.state(jobs.STATE)) == middle
    jobs.format_games(spark, layout, "2024-06-02", "incremental", multi_line=True)
    table = layout.table("formatted", jobs.GAMES, "games")
    assert lake.read_runs(spark, table).count() == len(games)


@pytest.mark.parametrize(("mode", "dated"), [("full", 4), ("incremental", 3)])
def test_what_cannot_be_read_is_set_aside(spark, tmp_path, games, mode, dated):
    layout, run = LakeLayout(str(tmp_path)), "2024-06-01"
    folder = tmp_path / "raw" / jobs.GAMES / "games" / f"dt={run}"
    records = [as_raw(g) for g in games[:6]]
    records[1]["id"], records[2]["id"], records[3]["date"] = "one", None, "unknown"
    good = json.dumps({"data": records})
    put(folder / "games.json", f"{good}\n{good[:300]}\n" + json.dumps({"data": []}) + "\n" + json.dumps({"error": 1}))
    if mode == "incremental":  # a mark that an older version left
        put(tmp_path / "metadata" / jobs.STATE / "part.json", json.dumps({"last_date": "unknown"}))
    jobs.format_games(spark, layout, run, mode)
    assert lake.read_run(spark, layout.table("formatted", jobs.GAMES, "games"), run).count() == dated
    aside = lake.read_run(spark, layout.table("quarantine", jobs.GAMES, "games"), run).collect()
    expected = ["no id", "no id", "no records", "unreadable payload"] + ["no date"] * (mode == "incremental")
    assert sorted(r.reason for r in aside) == sorted(expected)
    assert all("games.json" in r.file for r in aside)
    assert next(r.raw_text for r in aside if r.reason == "unreadable payload") == good[:300]
    assert read_state(spark, layout.state(jobs.STATE)) == max(str(g[1]) for g in (games[0], games[4], games[5]))


def test_an_old_day_again_gives_the_same_table(spark, tmp_path, games):
    layout = LakeLayout(str(tmp_path))
    land(tmp_path, "2024-06-01", games)
    jobs.format_games(spark, layout, "2024-06-01", multi_line=True)
    jobs.format_dimensions(spark, layout, "2024-06-01", multi_line=True)
    jobs.combine_layer(spark, layout, "2024-06-01")
    first = sorted(jobs.team_view(spark, layout, "2024-06-01").collect())
    later = [{**t, "full_name": "Renamed " + t["full_name"]} for t in TEAMS]
    put(tmp_path / "raw" / jobs.GAMES / "teams" / "dt=2024-06-05" / "teams.json", json.dumps(later, indent=1))
    put(tmp_path / "raw" / jobs.VENUES / "teams" / "dt=2024-06-05" / "teams.json", json.dumps({"teams": VENUES}, indent=1))
    jobs.format_dimensions(spark, layout, "2024-06-05", multi_line=True)
    jobs.combine_layer(spark, layout, "2024-06-01")
    assert sorted(jobs.team_view(spark, layout, "2024-06-01").collect()) == first
    with pytest.raises(RuntimeError):
        jobs.combine_layer(spark, layout, "2024-05-01")


def test_a_day_from_the_command_line(spark, tmp_path, games, capsys):
    land(tmp_path, "2024-06-01", games)
    daily.main([str(tmp_path), "2024-06-01", "--cutoff", CUTOFF, "--multi-line", "--seasons", "2024", "2024",
                "--dates", "2024-01-10", "-", "--schedule", "simple"])
    assert set(json.loads(capsys.readouterr().out)) >= {"train_auc", "test_auc"}
    team = jobs.team_view(spark, LakeLayout(str(tmp_path)), "2024-06-01")
    assert str(team.agg({"game_date": "min"}).first()[0]) >= "2024-01-10"


def test_nothing_landed(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    with pytest.raises(RuntimeError):
        jobs.format_games(spark, layout, "2024-06-01")
    with pytest.raises(RuntimeError):
        jobs.format_dimensions(spark, layout, "2024-06-01")
    with pytest.raises(ValueError):
        jobs.run(spark, layout, "2024-06-01", CUTOFF, mode="other")
    land(tmp_path, "2024-06-01", [])
    with pytest.raises(RuntimeError):
        jobs.format_games(spark, layout, "2024-06-01", multi_line=True)


def test_a_load_is_measured_by_its_writes(spark, tmp_path, games):
    layout, run = LakeLayout(str(tmp_path)), "2024-06-01"
    land(tmp_path, run, games + games[:20])
    put(tmp_path / "raw" / jobs.GAMES / "games" / f"dt={run}" / "bad.json", '{"data": [{"id": "x"}, {"date": "2024-01-01"}]}')
    context, jobs_of = spark.sparkContext, {}
    for mode in ("full", "incremental"):
        context.setJobGroup(f"load-{mode}", mode)
        load = jobs.format_games(spark, layout, run, mode, multi_line=True)
        jobs_of[mode] = len(context.statusTracker().getJobIdsForGroup(f"load-{mode}"))
        if mode == "full":
            assert load == jobs.Load(300, str(max(g[1] for g in games)), 2)
        else:
            assert load == jobs.Load(0, None, 2)  # nothing is after the mark
    context.setLocalProperty("spark.jobGroup.id", None)
    # parse, quarantine, dedup and write (shuffle and result), state; nothing that only counts
    assert jobs_of["full"] <= 7, jobs_of
    assert jobs_of["incremental"] <= 4, jobs_of


def test_exports_of_changes_follow_the_table(spark, tmp_path, games):
    layout, days = LakeLayout(str(tmp_path)), ("2024-06-01", "2024-06-02")
    middle = sorted(g[1] for g in games)[200]
    land(tmp_path, days[0], [g for g in games if g[1] <= middle])
    land(tmp_path, days[1], games[20:])
    for day in days:
        jobs.format_games(spark, layout, day, multi_line=True)
        jobs.format_dimensions(spark, layout, day, multi_line=True)
        jobs.combine_layer(spark, layout, day)
        jobs.train_layer(spark, layout, day, CUTOFF)
        jobs.export_layer(spark, layout, day, "changes")
        jobs.export_layer(spark, layout, day)
    for index in ("team_metrics", "match_metrics"):
        numbers = [int(d.replace("-", "")) for d in days]
        held = applied_all(spark, jobs.change_export(layout, index), numbers)
        whole = read_bulk(spark, layout.table("export", jobs.GAMES, index), index)
        assert sorted(r.doc for r in held.collect()) == sorted(r.doc for r in whole.collect())


def test_the_kind_of_export_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.run(spark, LakeLayout(str(tmp_path)), "2024-06-01", CUTOFF, export="some")
