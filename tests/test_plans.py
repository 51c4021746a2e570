"""The plans at scale: what is shuffled, how often, and what reaches the scan."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from league import GAMES, random_games
from pyspark.sql import functions as F

from leaguelake import fixtures, scale
from leaguelake.operators import form as form_module
from leaguelake.operators import lanes
from leaguelake.operators import schedule as schedule_module
from leaguelake.operators.dedup import latest_run
from leaguelake.operators.form import team_form
from leaguelake.operators.lanes import enter
from leaguelake.operators.matches import match_rows
from leaguelake.operators.schedule import schedule_constants, schedule_strength
from leaguelake.operators.sides import TEAM_GAMES, side_split
from leaguelake.plans import metrics
from leaguelake.scale import stored

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(df, operator: str) -> int:
    return len(re.findall(rf"(?:\+- |:- )(?:\*\(\d+\) )?{operator}\b", plan(df)))


@pytest.fixture(scope="module")
def games(spark):
    return stored(spark.createDataFrame(random_games(300, 6, 40, seed=3), GAMES), "games")


def test_all_team_windows_share_one_shuffle_and_one_sort(games):
    form = team_form(side_split(games))
    assert count(form, "Exchange") == 1
    assert count(form, "Sort") == 1
    assert plan(form).count("FileScan") == 1


def test_a_match_row_costs_one_more_shuffle(spark, games):
    dim = spark.createDataFrame([(0, "a")], "team_id long, team_name string")
    rows = match_rows(schedule_constants(team_form(side_split(games))), dim)
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(rows))
    assert shuffles == ["game_id", "team_id"]
    assert count(rows, "SortMergeJoin") == 0


def test_copies_are_reduced_before_the_shuffle(games):
    text = plan(latest_run(games.withColumn("dt", F.lit("x")), ["game_id"]))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_a_stored_table_is_broadcast_by_its_size_only(spark, games):
    small = stored(spark.range(10).withColumnRenamed("id", "game_id"), "small")
    assert "BroadcastHashJoin" in plan(games.join(small, "game_id", "left"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(games.join(small, "game_id", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_edges_reach_the_shuffle_reduced(games):
    text = plan(enter(side_split(games), TEAM_GAMES, before=5, max_rows=20).rows)
    # One partial limit ahead of the shuffle, one final limit behind it.
    assert text.count("WindowGroupLimit") == 2


def test_joins_do_not_grow_with_the_horizon(spark, games):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = {h: count(schedule_strength(side_split(games), h), "SortMergeJoin") for h in (2, 5, 10)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert joins[2] == joins[5] == joins[10] <= 2


@pytest.mark.parametrize("kind", ["constant", "simple", "strength"])
def test_a_schedule_costs_no_second_pass_over_the_timelines(spark, games, kind, monkeypatch):
    passes = []
    whole = lanes.enter
    for module in (form_module, schedule_module, metrics):
        monkeypatch.setattr(module, "enter", lambda df, *a, **k: passes.append(a[0].entity) or whole(df, *a, **k))
    metrics.team_rows(games, kind).count()
    assert passes == [("team_id",)]


def test_scratch_is_deleted(spark):
    with scale.scratch(spark, "job"):
        path = scale.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert not Path(path.removeprefix("file:")).parent.exists()


def test_temporary_folders_are_refused_on_a_cluster():
    assert scale.is_temporary("/tmp/x") and scale.is_temporary("file:/tmp/x") and scale.is_temporary("file:///var/tmp/a")
    assert not scale.is_temporary("hdfs://store/tmp/x") and not scale.is_temporary("/mnt/shared/x")


def test_scans_read_only_the_columns_needed(spark):
    text = plan(fixtures.games(spark, SF).select("game_id", "home_team_id"))
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert sorted(schemas) == [
        "struct<c_custkey:bigint,c_nationkey:int>",
        "struct<o_orderkey:bigint,o_custkey:bigint>",
    ]


def test_no_python_worker_in_any_expression(games):
    for operator in ("Python", "Arrow", "MapIn", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan(team_form(side_split(games), max_rows=20))


def test_task_rows_is_a_session_setting(spark, games):
    assert scale.task_rows(spark) == scale.DEFAULT_TASK_ROWS
    spark.conf.set(scale.TASK_ROWS, "25")
    try:
        assert enter(side_split(games), TEAM_GAMES).split
    finally:
        spark.conf.unset(scale.TASK_ROWS)
    assert not enter(side_split(games), TEAM_GAMES).split


def test_scratch_follows_the_checkpoint_setting(spark):
    shared = spark.conf.get(scale.CHECKPOINT_DIR)
    assert scale.scratch_path(spark, "x").startswith(f"{shared}/leaguelake/x-")
    assert scale.scratch_path(spark, "x") != scale.scratch_path(spark, "x")


def test_cut_form_reads_few_files(spark):
    """Lanes of 20 rows, as many files as partitions of a shuffle: each file is a task and a result for the driver."""
    games = spark.createDataFrame(random_games(3000, 6, 40, seed=3), GAMES)
    form = team_form(side_split(games), max_rows=20)
    assert len(form.inputFiles()) <= 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert form.count() == 6000
