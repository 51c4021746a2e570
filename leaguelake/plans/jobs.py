"""The daily jobs in order: format, combine, train, export. No clock: the run date is an argument."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leaguelake.layout import RUN, LakeLayout
from leaguelake.operators.dedup import latest_run
from leaguelake.operators.dims import team_dim
from leaguelake.plans import cube, metrics, model
from leaguelake.scale import scratch, stored
from leaguelake.sinks.changes import ChangeExport
from leaguelake.sinks.documents import write_bulk
from leaguelake.sinks.state import write_state
from leaguelake.sources import lake, raw
from leaguelake.sources.incremental import (
    guard_nonempty,
    incremental_slice,
    read_state,
)

GAMES, VENUES = "games_api", "venues_api"
STATE = "ingestion_last_run"
SCHEDULE_KEYS = ["schedule_difficulty_next5", "home_games_next5", "away_games_next5"]
MODES = ("full", "incremental", "all_runs")
EXPORTS = ("all", "changes")


@dataclass(frozen=True)
class Load:
    """What a load wrote: games, their newest day, and rows set aside."""

    games: int = 0
    last_date: str | None = None
    quarantined: int = 0


def format_games(
    spark: SparkSession,
    layout: LakeLayout,
    run_date: str,
    mode: str = "full",
    seasons: tuple[int, int] | None = None,
    dates: tuple[str | None, str | None] = (None, None),
    multi_line: bool = False,
) -> Load:
    """Raw games to the formatted table, one row per game, and move the high-water mark.

    ``full`` reads the raw run of ``run_date``, ``all_runs`` every raw run (the newest copy of a game
    wins), and ``incremental`` what the run of ``run_date`` has after the mark; there a missing run
    or an empty slice changes nothing. Payloads that cannot be read, games without an id, and in an
    incremental load games without a readable date go to the run's quarantine. The mark is the newest
    day really loaded, so what filters left out is still new to the next incremental load.

    What was loaded and set aside is measured by the writes themselves, in tasks whose result counts
    once however often they run; no job looks at the data again.
    """
    root = layout.table("raw", GAMES, "games")
    path = root if mode == "all_runs" else layout.run("raw", GAMES, "games", run_date)
    records = lake.if_present(lambda: raw.read_games_checked(spark, path, multi_line))
    if records is None:
        if mode == "incremental":
            return Load()
        raise RuntimeError(f"no raw games at {path}")
    if RUN not in records.columns:
        records = records.withColumn(RUN, F.lit(run_date).cast("date"))
    rows = raw.format_games(records)
    if mode == "incremental":
        undated = F.when(F.col("game_date").isNull(), raw.NO_DATE)
        rows = rows.withColumn(raw.REASON, F.coalesce(raw.REASON, undated))
    readable = F.col(raw.REASON).isNull()
    state = layout.state(STATE)
    mark = read_state(spark, state) if mode == "incremental" else None
    wanted = _wanted(mark, seasons, dates)
    parsed = Observation("parsed-games")
    counts = F.count_if(readable & wanted).alias("wanted"), F.count_if(~readable).alias("quarantined")
    rows = stored(rows.observe(parsed, *counts), "parsed-games")
    lake.write_run(raw.quarantined(rows), layout.table("quarantine", GAMES, "games"), run_date)

    measures = Load(quarantined=parsed.get["quarantined"])
    if not parsed.get["wanted"]:
        if mode == "incremental":
            return measures
        raise RuntimeError("no games in a full load")
    good = rows.where(readable).drop(raw.REASON, raw.RAW_TEXT, raw.FILE)
    if mark is not None:
        good = incremental_slice(good, mark)
    games = latest_run(good, ["game_id"]).drop(RUN).where(_wanted(None, seasons, dates))
    written = Observation("written-games")
    newest = F.max("game_date").cast("string").alias("last_date")
    games = games.observe(written, F.count(F.lit(1)).alias("games"), newest)
    lake.write_run(games, layout.table("formatted", GAMES, "games"), run_date)
    measures = Load(written.get["games"], written.get["last_date"], measures.quarantined)
    if measures.last_date is not None:
        mark_row = [(measures.last_date, measures.games)]
        write_state(spark.createDataFrame(mark_row, "last_date string, last_game_count long"), state, run_date)
    return measures


def _wanted(
    mark: str | None, seasons: tuple[int, int] | None, dates: tuple[str | None, str | None]
) -> Column:
    """Whether a game is after the mark and within the filters; a game whose day or season it needs and
    lacks is not."""
    first, last = dates
    asked = [
        None if mark is None else F.col("game_date") > F.lit(mark).cast("date"),
        None if seasons is None else F.col("season").between(*seasons),
        None if first is None else F.col("game_date") >= F.lit(first).cast("date"),
        None if last is None else F.col("game_date") <= F.lit(last).cast("date"),
    ]
    return F.coalesce(functools.reduce(Column.__and__, [a for a in asked if a is not None], F.lit(True)), F.lit(False))


def format_dimensions(
    spark: SparkSession,
    layout: LakeLayout,
    run_date: str,
    required: bool = True,
    multi_line: bool = False,
) -> None:
    """Raw teams and venues to formatted tables, one row per key.

    Payloads that cannot be read and records without an id go to the run's quarantine. Where they are not ``required`` a missing run leaves the newest earlier one in use.
    """
    for source, key, read, shape in (
        (GAMES, "team_id", raw.read_teams_checked, raw.format_teams),
        (VENUES, "team_name_norm", raw.read_venues_checked, raw.format_venues),
    ):
        path = layout.run("raw", source, "teams", run_date)
        records = lake.if_present(functools.partial(read, spark, path, multi_line))
        if records is None and not required:
            continue
        if records is None:
            raise RuntimeError(f"no raw teams at {path}")
        rows = stored(shape(records), "parsed-teams")
        lake.write_run(raw.quarantined(rows), layout.table("quarantine", source, "teams"), run_date)
        good = rows.where(F.col(raw.REASON).isNull()).drop(raw.REASON, raw.RAW_TEXT, raw.FILE)
        rows = latest_run(good.withColumn(RUN, F.lit(run_date)), [key]).drop(RUN)
        lake.write_run(guard_nonempty(rows, "teams"), layout.table("formatted", source, "teams"), run_date)


def combine_layer(
    spark: SparkSession,
    layout: LakeLayout,
    run_date: str,
    all_runs: bool = False,
    schedule: str = "constant",
    status: str | None = None,
) -> None:
    """Formatted tables to team_metrics, its cube and match_metrics; the team windows run once for all.

    Games are made unique before any window: a second copy would count as a game played earlier.
    """
    table = layout.table("formatted", GAMES, "games")
    if all_runs:
        games = stored(latest_run(lake.read_runs(spark, table), ["game_id"]).drop(RUN), "games")
    else:
        games = lake.read_run(spark, table, run_date)
    teams = lake.read_latest_run(spark, layout.table("formatted", GAMES, "teams"), run_date)
    venues = lake.read_latest_run(spark, layout.table("formatted", VENUES, "teams"), run_date)
    dim = stored(team_dim(teams, venues), "team-dim")
    rows = stored(metrics.team_rows(games, schedule, status), "team-rows")
    for name, build in (
        ("team_metrics", metrics.team_metrics),
        ("match_metrics", metrics.match_metrics),
    ):
        lake.write_run(build(rows, dim), layout.table("combined", GAMES, name), run_date)
    made = cube.cells(team_view(spark, layout, run_date))
    cube.write_cells(made, layout.table("combined", GAMES, "team_cube"), run_date)


def train_layer(
    spark: SparkSession, layout: LakeLayout, run_date: str, cutoff: str, all_runs: bool = False
) -> dict[str, float]:
    """Fit, evaluate, and write predictions and model; ``all_runs`` learns from the newest row of
    every match over all runs up to ``run_date``."""
    table = layout.table("combined", GAMES, "match_metrics")
    if all_runs:
        upto = lake.read_runs(spark, table).where(F.col(RUN) <= F.lit(run_date).cast("date"))
        matches = latest_run(upto, ["game_id"]).drop(RUN)
    else:
        matches = lake.read_run(spark, table, run_date)
    trained = model.train(matches, cutoff)
    out = layout.table("combined", GAMES, "match_metrics_with_preds")
    lake.write_run(model.predictions(trained), out, run_date)
    trained.model.write().overwrite().save(layout.run("models", GAMES, "home_win", run_date))
    return model.evaluate(trained)


def change_export(layout: LakeLayout, index: str) -> ChangeExport:
    """Where the changes of an index are exported; an export's number is its run date as yyyymmdd."""
    key, keep = {
        "team_metrics": (("game_id", "team_id", "is_home"), tuple(SCHEDULE_KEYS)),
        "match_metrics": (("game_id",), ()),
    }[index]
    return ChangeExport(layout.table("export", GAMES, f"{index}_changes"), index, key, keep)


def export_layer(spark: SparkSession, layout: LakeLayout, run_date: str, export: str = "all") -> None:
    """Replace the documents of both indices, or write what ``changes`` since the export before."""
    team = lake.read_run(spark, layout.table("combined", GAMES, "team_metrics"), run_date)
    match = lake.read_run(
        spark, layout.table("combined", GAMES, "match_metrics_with_preds"), run_date
    )
    for index, rows, keep in (
        ("team_metrics", team, SCHEDULE_KEYS),
        ("match_metrics", match, ()),
    ):
        if export == "changes":
            change_export(layout, index).write(rows, int(run_date.replace("-", "")))
        else:
            write_bulk(rows, layout.table("export", GAMES, index), index, keep)


def run(
    spark: SparkSession,
    layout: LakeLayout,
    run_date: str,
    cutoff: str,
    mode: str = "full",
    schedule: str = "constant",
    multi_line: bool = False,
    seasons: tuple[int, int] | None = None,
    dates: tuple[str | None, str | None] = (None, None),
    status: str | None = None,
    train_on_all: bool = False,
    export: str = "all",
) -> dict[str, float]:
    """All jobs of one day; returns the model's scores and leaves no intermediate table behind."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if export not in EXPORTS:
        raise ValueError(f"export is one of {EXPORTS}")
    with scratch(spark, f"run-{run_date}"):
        format_games(spark, layout, run_date, mode, seasons, dates, multi_line)
        format_dimensions(spark, layout, run_date, mode != "incremental", multi_line)
        combine_layer(spark, layout, run_date, mode != "full", schedule, status)
        scores = train_layer(spark, layout, run_date, cutoff, train_on_all)
        export_layer(spark, layout, run_date, export)
    return scores


def team_view(spark: SparkSession, layout: LakeLayout, run_date: str) -> DataFrame:
    """The team table the dashboard reads."""
    return lake.read_run(spark, layout.table("combined", GAMES, "team_metrics"), run_date)


def team_cube(spark: SparkSession, layout: LakeLayout, run_date: str) -> DataFrame:
    """The cells of the team table, from which ``plans.cube`` answers the panels."""
    return lake.read_run(spark, layout.table("combined", GAMES, "team_cube"), run_date)


def match_view(spark: SparkSession, layout: LakeLayout, run_date: str) -> DataFrame:
    """The prediction table the dashboard reads, with the season its filter needs."""
    table = layout.table("combined", GAMES, "match_metrics")
    seasons = lake.read_run(spark, table, run_date).select("game_id", "season")
    preds = layout.table("combined", GAMES, "match_metrics_with_preds")
    return lake.read_run(spark, preds, run_date).join(seasons, "game_id", "left")
