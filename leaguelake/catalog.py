"""Every operator as a query over the test tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguelake import fixtures
from leaguelake.functions import beats, iso_date, name_key, whole_number
from leaguelake.layout import RUN
from leaguelake.operators import dedup, dims, form, ranking, schedule, sides
from leaguelake.operators.asof import asof_last, daily_last
from leaguelake.operators.lanes import Timeline
from leaguelake.operators.sides import TEAM_GAMES
from leaguelake.plans import cube, dashboard, metrics, model
from leaguelake.scale import scratch_path, stored
from leaguelake.sinks import documents
from leaguelake.sinks.changes import CHANGED, GONE, NEW, ChangeExport, applied_all
from leaguelake.sinks.state import write_state
from leaguelake.sources import incremental, lake, raw
from leaguelake.plans.form_table import FormTable
from leaguelake.streaming.games import current_games, current_table, load_new_games

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_RUN, SECOND_RUN, THIRD_RUN = "2001-09-01", "2001-09-02", "2001-09-03"
SPLIT_SEASON = 1998  # the first run lands seasons up to it, the second lands it again and the rest
SPLIT_ROWS = 500  # makes every team of the small tables a hot one


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -------------------------------------------------------------------------------


def _sides(spark: SparkSession, sf: str) -> DataFrame:
    return sides.side_split(fixtures.games(spark, sf))


def _teams(spark: SparkSession, sf: str) -> DataFrame:
    return raw.format_teams(fixtures.raw_teams(spark, sf))


def _venues(spark: SparkSession, sf: str) -> DataFrame:
    return raw.format_venues(fixtures.raw_venues(spark, sf))


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.team_dim(_teams(spark, sf), _venues(spark, sf))


def _team(spark: SparkSession, sf: str, schedule_kind: str = "constant") -> DataFrame:
    rows = metrics.team_rows(fixtures.games(spark, sf), schedule_kind)
    return metrics.team_metrics(rows, _dim(spark, sf))


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.match_metrics(metrics.team_rows(fixtures.games(spark, sf)), _dim(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Matches with a probability that needs no model: half the difference of the win rates."""
    gap = F.coalesce("home_win_rate", F.lit(0.5)) - F.coalesce("away_win_rate", F.lit(0.5))
    return _matches(spark, sf).withColumn(
        "win_probability_home", F.round(F.lit(0.5) + F.lit(0.5) * gap, 6)
    )


def _called(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).withColumn(
        "prediction", (F.col("win_probability_home") > 0.5).cast("int")
    )


def _flat(raw_games: DataFrame) -> DataFrame:
    """Raw records with the nested ids as columns."""
    return raw_games.select(
        "id",
        "date",
        "season",
        "status",
        F.col("home_team.id").alias("home_id"),
        F.col("visitor_team.id").alias("visitor_id"),
        "home_team_score",
        "visitor_team_score",
        *[c for c in raw_games.columns if c == RUN],
    )


def _land_runs(spark: SparkSession, sf: str) -> str:
    """Two overlapping runs, one wrapped and one bare; the second corrects the shared season."""
    root = scratch_path(spark, "raw-games")
    games = fixtures.raw_games(spark, sf)
    season = F.col("season").cast("int")
    fixtures.land_wrapped(games.where(season <= SPLIT_SEASON), f"{root}/{RUN}={FIRST_RUN}")
    corrected = games.where(season >= SPLIT_SEASON).withColumn("status", F.lit("FINAL"))
    fixtures.land_bare(corrected, f"{root}/{RUN}={SECOND_RUN}")
    return root


def _lake_games(spark: SparkSession, sf: str) -> str:
    """Formatted games of the two runs in one partitioned table."""
    table = scratch_path(spark, "games")
    games = fixtures.games(spark, sf)
    lake.write_run(games.where(F.col("season") <= SPLIT_SEASON), table, FIRST_RUN)
    corrected = games.where(F.col("season") >= SPLIT_SEASON).withColumn("status", F.lit("final"))
    lake.write_run(corrected, table, SECOND_RUN)
    return table


# --- sources -------------------------------------------------------------------------------------


@query
def src_json_games(spark, sf):
    path = scratch_path(spark, "games-json")
    fixtures.land_documents(fixtures.raw_games(spark, sf), path)
    return _flat(raw.read_games(spark, path, multi_line=True))


@query
def src_json_all_runs(spark, sf):
    return _flat(raw.read_games(spark, _land_runs(spark, sf)))


@query
def src_json_teams(spark, sf):
    path = scratch_path(spark, "teams-json")
    fixtures.land_bare(fixtures.raw_teams(spark, sf), path)
    return raw.read_teams(spark, path)


@query
def src_json_venues(spark, sf):
    path = scratch_path(spark, "venues-json")
    venues = fixtures.raw_venues(spark, sf).withColumn("id", F.col("idTeam").cast("long"))
    fixtures.land_wrapped(venues, path, wrapper="teams")
    return raw.read_venues(spark, path)


@query
def src_parquet_run(spark, sf):
    return lake.read_run(spark, _lake_games(spark, sf), SECOND_RUN)


@query
def src_parquet_all_runs(spark, sf):
    return lake.read_runs(spark, _lake_games(spark, sf))


@query
def json_unwrap(spark, sf):
    path = scratch_path(spark, "mixed")
    games = fixtures.raw_games(spark, sf)
    odd = F.col("id") % 2 == 1
    fixtures.land_wrapped(games.where(~odd), f"{path}/wrapped")
    fixtures.land_bare(games.where(odd), f"{path}/bare")
    return _flat(raw.read_games(spark, f"{path}/*"))


@query
def page_union(spark, sf):
    """Pages that overlap: every record whose id ends in 99 or 00 comes on two pages."""
    path = scratch_path(spark, "pages")
    games = fixtures.raw_games(spark, sf)
    fixtures.land_wrapped(games, f"{path}/pages")
    edge = games.where((F.col("id") % 100).isin(0, 99))
    fixtures.land_wrapped(edge, f"{path}/overlap")
    pages = _flat(raw.read_games(spark, f"{path}/*"))
    return dedup.any_copy(pages, ["id"])


@query
def filter_season(spark, sf):
    return incremental.in_seasons(fixtures.games(spark, sf), 1996, 1998)


@query
def filter_date_range(spark, sf):
    return incremental.in_dates(fixtures.games(spark, sf), "1997-03-01", "1999-06-30")


@query
def incremental_slice(spark, sf):
    """Games after the mark left by a first load of the seasons up to 1998."""
    path = scratch_path(spark, "state")
    first = fixtures.raw_games(spark, sf).where(F.col("season").cast("int") <= SPLIT_SEASON)
    write_state(incremental.high_water_mark(first), path, FIRST_RUN)
    return incremental.incremental_slice(
        fixtures.games(spark, sf), incremental.read_state(spark, path)
    )


@query
def high_water_mark(spark, sf):
    return incremental.high_water_mark(fixtures.raw_games(spark, sf))


@query
def high_water_mark_dirty(spark, sf):
    """Every eleventh date is no date."""
    games = fixtures.raw_games(spark, sf)
    date = F.when(F.col("id") % 11 == 0, "unknown").otherwise(F.col("date"))
    return incremental.high_water_mark(games.withColumn("date", date))


@query
def raw_quarantine(spark, sf):
    """Every tenth page breaks off, and some ids are no numbers: all rows are loaded or set aside."""
    path = scratch_path(spark, "dirty")
    games = fixtures.raw_games(spark, sf)
    text_id = F.when(F.col("id") % 50 == 7, F.concat(F.lit("game "), F.col("id").cast("string")))
    text_id = text_id.otherwise(F.col("id").cast("string"))
    rows = games.withColumn("text_id", text_id)
    fields = [F.col("text_id").alias("id"), *games.columns[1:]]
    pages = rows.groupBy(F.floor(F.col("id") / fixtures.PAGE_ROWS).alias("block")).agg(
        F.collect_list(F.struct(*fields)).alias("data")
    )
    # ids that are numbers are written as numbers
    page = F.regexp_replace(F.to_json(F.struct("data")), r'"id":"(\d+)"', r'"id":$1')
    broken = F.when(F.col("block") % 10 == 3, F.substring(page, F.lit(1), F.length(page) - 9))
    pages.select(F.coalesce(broken, page)).write.text(path)
    rows = raw.format_games(raw.read_games_checked(spark, path))
    return rows.groupBy(F.coalesce(raw.REASON, F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col(raw.REASON).isNull(), F.col("game_id"))).alias("id_sum"),
    )


def _land_dirty(records: DataFrame, path: str, wrapper: str, rows: int, faults: dict) -> None:
    """Pages of the records as JSON, changed by ``faults`` (pattern: (condition, replacement)); every fourth
    page breaks off in its last record. ``records`` needs a unique ``key``."""
    text = F.to_json(F.struct(*[c for c in records.columns if c != "key"]))
    for pattern, (condition, replacement) in faults.items():
        text = F.when(condition, F.regexp_replace(text, pattern, replacement)).otherwise(text)
    lines = records.select(F.floor(F.col("key") / rows).alias("block"), "key", text.alias("text"))
    pages = lines.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("own"))
    page = F.concat(F.lit(f'{{"{wrapper}":['), F.array_join(F.transform("own", lambda r: r["text"]), ","), F.lit("]}"))
    broken = F.when(F.col("block") % 4 == 1, F.substring(page, F.lit(1), F.length(page) - 9))
    pages.select(F.coalesce(broken, page)).write.text(path)


def _outcomes(rows: DataFrame, number: str) -> DataFrame:
    """Records loaded and set aside, by reason; what was set aside has its text."""
    good = F.col(raw.REASON).isNull()
    return rows.groupBy(F.coalesce(raw.REASON, F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(good, F.col(number).cast("long"))).alias("id_sum"),
        F.count(F.when(good == (F.col(raw.RAW_TEXT).isNull()), True)).alias("n_consistent"),
    )


@query
def raw_quarantine_teams(spark, sf):
    path = scratch_path(spark, "dirty-teams")
    teams = fixtures.raw_teams(spark, sf).withColumn("key", F.col("id"))
    faults = {r'"id":\d+': (F.col("key") % 7 == 3, '"id":"none"')}
    _land_dirty(teams, path, "data", 5, faults)
    return _outcomes(raw.format_teams(raw.read_teams_checked(spark, path)), "team_id")


@query
def raw_quarantine_venues(spark, sf):
    path = scratch_path(spark, "dirty-venues")
    venues = fixtures.raw_venues(spark, sf).withColumn("key", F.col("idTeam").cast("long"))
    faults = {r'"idTeam":"\d+",': (F.col("key") % 6 == 2, "")}
    _land_dirty(venues, path, "teams", 4, faults)
    return _outcomes(raw.format_venues(raw.read_venues_checked(spark, path)), "thesportsdb_team_id")


@query
def raw_mistyped_games(spark, sf):
    """A home team that is a number, and a visitor whose id is a word: the record goes aside with its text."""
    path = scratch_path(spark, "mistyped")
    games = fixtures.raw_games(spark, sf).withColumn("key", F.col("id"))
    faults = {
        r'"home_team":\{[^}]*\}': (F.col("key") % 40 == 3, '"home_team":7'),
        r'"visitor_team":\{"id":\d+': (F.col("key") % 40 == 9, '"visitor_team":{"id":"x"'),
        r'"home_team_score":': (F.col("key") % 40 == 11, '"score":'),
    }
    _land_dirty(games, path, "data", 100, faults)
    return _outcomes(raw.format_games(raw.read_games_checked(spark, path)), "game_id")


@query
def dims_of_run(spark, sf):
    """Two runs of the teams; a job of the first day must not see the second."""
    table = scratch_path(spark, "teams")
    teams = _teams(spark, sf)
    lake.write_run(teams, table, FIRST_RUN)
    lake.write_run(teams.withColumn("conference", F.lit("later")), table, SECOND_RUN)
    return lake.read_latest_run(spark, table, FIRST_RUN)


@query
def guard_nonempty(spark, sf):
    games = incremental.guard_nonempty(fixtures.games(spark, sf), "games")
    venues = incremental.guard_nonempty(_venues(spark, sf), "venues")
    n = F.count(F.lit(1)).alias("n_rows")
    return (
        games.agg(n)
        .select(F.lit("games").alias("source"), "n_rows")
        .unionByName(venues.agg(n).select(F.lit("venues").alias("source"), "n_rows"))
    )


# --- sinks ---------------------------------------------------------------------------------------


@query
def sink_parquet_roundtrip(spark, sf):
    """Both runs written, the second one twice; all rows read back once."""
    table = _lake_games(spark, sf)
    again = stored(lake.read_run(spark, table, SECOND_RUN), "again")
    lake.write_run(again, table, SECOND_RUN)
    return lake.read_runs(spark, table)


def _document_fields(docs: DataFrame, like: DataFrame) -> DataFrame:
    """Every field of the documents, and how many each has."""
    return docs.select(F.from_json("doc", like.schema).alias("d"), "doc").select(
        "d.*", F.size(F.json_object_keys("doc")).cast("int").alias("n_fields")
    )


@query
def doc_json(spark, sf):
    docs = _team(spark, sf)
    return _document_fields(docs.select(documents.document(docs).alias("doc")), docs)


@query
def doc_json_keep_nulls(spark, sf):
    """Documents of the look-ahead table; difficulty stays as null where no game follows."""
    strength = schedule.schedule_strength(_sides(spark, sf))
    doc = documents.document(strength, keep_nulls=["schedule_difficulty_next5"])
    read = _document_fields(strength.select(doc.alias("doc")), strength)
    return read.withColumn("schedule_difficulty_next5", F.round("schedule_difficulty_next5", 6))


@query
def sink_bulk_ndjson(spark, sf):
    """The export written and read back: every field of every document, split at the action lines."""
    path = scratch_path(spark, "bulk")
    matches = _matches(spark, sf)
    documents.write_bulk(matches, path, "match_metrics")
    docs = documents.read_bulk(spark, path, "match_metrics")
    return docs.select(F.from_json("doc", matches.schema).alias("d")).select("d.*")


@query
def sink_bulk_requests(spark, sf):
    """The export cut into requests: all documents, each behind its action line, at most 500 in one."""
    path = scratch_path(spark, "bulk")
    documents.write_bulk(fixtures.games(spark, sf), path, "games")
    requests = documents.bulk_requests(spark, path, "games")
    actions = F.regexp_count("body", F.lit(r'(?m)^\{"index": \{"_index": "games"\}\}$'))
    return requests.agg(
        F.sum("documents").alias("documents"),
        F.sum(actions).alias("actions"),
        (F.max("documents") <= documents.BATCH_SIZE).alias("within"),
    )


def _change_export(spark: SparkSession, sf: str) -> tuple[ChangeExport, DataFrame]:
    """Two exports of the match table: the first lacks later seasons, has other scores in its last
    season, and of that season as many matches more that the second no longer has."""
    matches = stored(_matches(spark, sf), "matches")
    export = ChangeExport(scratch_path(spark, "changes"), "match_metrics", ("game_id",), buckets=8)
    last = matches.where(F.col("season") == SPLIT_SEASON)
    early = matches.where(F.col("season") < SPLIT_SEASON)
    other = last.withColumn("home_team_score", F.col("home_team_score") + 1)
    extra = last.withColumn("game_id", -F.col("game_id") - 1)
    export.write(early.unionByName(other).unionByName(extra), 1)
    export.write(matches, 2)
    return export, matches


@query
def sink_changes(spark, sf):
    """The match table as an index holds it after both exports of changes: every field."""
    export, matches = _change_export(spark, sf)
    docs = applied_all(spark, export, (1, 2))
    return docs.select(F.from_json("doc", matches.schema).alias("d")).select("d.*")


@query
def sink_change_counts(spark, sf):
    """What the second export sends: new matches, changed ones, and ids to delete."""
    export, matches = _change_export(spark, sf)
    sent = export.read(spark, 2).withColumn("game_id", F.col("id").cast("long"))
    late = matches.where(F.col("season") > SPLIT_SEASON).select("game_id", F.lit(True).alias("late"))
    kind = F.when(F.col("doc").isNull(), GONE).when(F.col("late"), NEW).otherwise(CHANGED)
    marked = sent.join(late, "game_id", "left").select(kind.alias("kind"), "game_id")
    return marked.groupBy("kind").agg(F.count(F.lit(1)).alias("documents"), F.sum("game_id").alias("id_sum"))


@query
def doc_batches(spark, sf):
    batches = documents.with_batch(fixtures.games(spark, sf))
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("docs"),
        F.min("game_date").alias("first_date"),
        F.max("game_date").alias("last_date"),
        F.sum("game_id").alias("id_sum"),
    )


@query
def doc_batches_split(spark, sf):
    """The same numbering when the rows are too many for one task."""
    batches = documents.with_batch(fixtures.games(spark, sf), max_rows=SPLIT_ROWS)
    return batches.select("game_id", "batch")


# --- cleaning ------------------------------------------------------------------------------------


@query
def format_games(spark, sf):
    return raw.format_games(fixtures.raw_games(spark, sf))


@query
def format_teams(spark, sf):
    return _teams(spark, sf)


@query
def format_venues(spark, sf):
    return _venues(spark, sf)


@query
def cast_date(spark, sf):
    """ISO text of every order date, every seventh one unreadable."""
    orders = fixtures.table(spark, sf, "orders")
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:30:00.000Z"))
    text = F.when(F.col("o_orderkey") % 7 == 0, "unknown").otherwise(iso)
    return orders.select("o_orderkey", iso_date(text).alias("game_date"))


@query
def cast_int(spark, sf):
    supplier = fixtures.table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    text = F.when(key % 5 == 0, "n/a").otherwise((10000 + key * 37).cast("string"))
    return supplier.select("s_suppkey", whole_number(text).alias("capacity"))


@query
def normalize_name(spark, sf):
    customer = fixtures.table(spark, sf, "customer")
    return customer.select("c_custkey", name_key(F.col("c_name")).alias("name_norm"))


@query
def home_win_flag(spark, sf):
    games = fixtures.games(spark, sf)
    won = beats(F.col("home_team_score"), F.col("visitor_team_score"))
    return games.select("game_id", won.alias("home_win"))


# --- reshape and dedup ---------------------------------------------------------------------------


@query
def side_split(spark, sf):
    return _sides(spark, sf)


@query
def union_by_name(spark, sf):
    games = fixtures.games(spark, sf)
    return sides.one_side(games, 1).unionByName(sides.one_side(games, 0))


@query
def dedup_games(spark, sf):
    runs = lake.read_runs(spark, _lake_games(spark, sf))
    return dedup.latest_run(runs, ["game_id"], RUN)


@query
def dedup_team_game(spark, sf):
    rows = _sides(spark, sf)
    return dedup.any_copy(rows.unionByName(rows), ["game_id", "team_id"])


@query
def consolidate_runs(spark, sf):
    """All raw runs to one formatted table; the later run wins."""
    records = raw.read_games(spark, _land_runs(spark, sf))
    return dedup.latest_run(raw.format_games(records), ["game_id"], RUN).drop(RUN)


# --- joins ---------------------------------------------------------------------------------------


@query
def team_dim(spark, sf):
    return _dim(spark, sf)


@query
def team_metrics(spark, sf):
    return _team(spark, sf)


@query
def match_metrics(spark, sf):
    return _matches(spark, sf)


def _difficulty_as_double(df: DataFrame) -> DataFrame:
    """Stored as float; compared as a rounded double."""
    names = [c for c in df.columns if "schedule_difficulty" in c]
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in names})


@query
def team_metrics_strength(spark, sf):
    """The team table with strength of schedule in place of the placeholder values."""
    return _difficulty_as_double(_team(spark, sf, "strength"))


@query
def match_metrics_simple(spark, sf):
    """The match table with the look-ahead counts in place of the placeholder values."""
    rows = metrics.team_rows(fixtures.games(spark, sf), "simple")
    return _difficulty_as_double(metrics.match_metrics(rows, _dim(spark, sf)))


@query
def opponent_form_asof(spark, sf):
    """The opponent's last known form on the date of every game."""
    rows = form.team_form(_sides(spark, sf)).select(
        "game_id", "game_date", "team_id", "opponent_id", "win_rate_last5"
    )
    rows = stored(rows, "form")
    known = daily_last(rows, "team_id", "game_date", "win_rate_last5", "game_id")
    probes = rows.select(F.col("opponent_id").alias("team_id"), "game_date")
    found = stored(asof_last(probes, known, "team_id", "game_date", "win_rate_last5"), "asof")
    found = found.toDF("opponent_id", "game_date", "opponent_form")
    return rows.join(found, ["opponent_id", "game_date"], "left").select(
        "game_id", "team_id", "opponent_id", "opponent_form"
    )


# --- windows -------------------------------------------------------------------------------------

_CUM = ["points_for", "points_against", "is_win"]


@query
def game_number(spark, sf):
    return form.prior_cumulative(_sides(spark, sf), TEAM_GAMES, []).select(
        "game_id", "team_id", "game_number"
    )


@query
def prior_cumulative(spark, sf):
    return form.prior_cumulative(_sides(spark, sf), TEAM_GAMES, _CUM).select(
        "game_id", "team_id", "games_played", *[f"{c}_cum" for c in _CUM]
    )


_RATES = ["win_rate", "avg_points_for", "avg_points_against"]


@query
def entering_rates(spark, sf):
    return form.team_form(_sides(spark, sf)).select("game_id", "team_id", *_RATES)


@query
def rolling_last5(spark, sf):
    return form.rolling_prior(_sides(spark, sf), TEAM_GAMES, _CUM).select(
        "game_id", "team_id", *[f"{c}_last5" for c in _CUM]
    )


@query
def form_last5(spark, sf):
    return form.team_form(_sides(spark, sf)).select(
        "game_id", "team_id", "win_rate_last5", "avg_points_last5"
    )


@query
def form_last5_actual(spark, sf):
    """Divided by the games there were, not by five."""
    return form.team_form(_sides(spark, sf), denominator="actual").select(
        "game_id", "team_id", "win_rate_last5", "avg_points_last5"
    )


@query
def form_by_season(spark, sf):
    """Form that starts afresh every season."""
    line = Timeline(("team_id", "season"), "game_date", ("game_id",))
    return form.team_form(_sides(spark, sf), line).select(
        "game_id", "team_id", "season", "games_played", "win_rate", "rest_days"
    )


@query
def rest_days(spark, sf):
    return form.rest(_sides(spark, sf), TEAM_GAMES).select("game_id", "team_id", "rest_days")


@query
def team_form_split(spark, sf):
    """All form columns with every team cut into lanes."""
    rows = form.team_form(_sides(spark, sf), max_rows=SPLIT_ROWS)
    return rows.select(
        "game_id",
        "team_id",
        "games_played",
        *_RATES,
        "win_rate_last5",
        "avg_points_last5",
        "rest_days",
    )


@query
def form_table(spark, sf):
    """The same from a kept table: early seasons with a wrong score in the last of them, then the rest."""
    games, season = fixtures.games(spark, sf), F.col("season")
    wrong = F.when(season == SPLIT_SEASON, F.col("home_team_score") + 1).otherwise(F.col("home_team_score"))
    table = FormTable(scratch_path(spark, "form"), buckets=8)
    table.update(games.where(season <= SPLIT_SEASON).withColumn("home_team_score", wrong), 1)
    table.update(games.where(season >= SPLIT_SEASON), 2)
    rate = ["win_rate_last5", "avg_points_last5", "rest_days"]
    return table.read(spark).select("game_id", "team_id", "games_played", *_RATES, *rate)


@query
def customer_orders_before(spark, sf):
    """The same windows over another timeline: what every customer ordered before each order."""
    orders = fixtures.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.floor("o_totalprice").cast("long").alias("price"),
    )
    line = Timeline(("custkey",), "day", ("orderkey",))
    return form.prior_cumulative(orders, line, ["price"]).select(
        "orderkey", "custkey", "games_played", "price_cum"
    )


def _user_events(spark, sf, max_rows=None):
    """Whole cents of each user's five events before every event."""
    events = fixtures.table(spark, sf, "events").select(
        "user_id",
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    line = Timeline(("user_id",), "day", ("ts", "event_id"))
    rows = form.rolling_prior(events, line, ["cents"], max_rows=max_rows)
    return rows.select("event_id", "user_id", "cents_last5")


@query
def user_events_last5(spark, sf):
    return _user_events(spark, sf)


@query
def user_events_last5_split(spark, sf):
    """The same with every user cut into lanes."""
    return _user_events(spark, sf, 20)


# --- schedule ------------------------------------------------------------------------------------

_NEXT5 = ["schedule_difficulty_next5", "home_games_next5", "away_games_next5"]


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


@query
def schedule_stub(spark, sf):
    return schedule.schedule_constants(_sides(spark, sf)).select("game_id", "team_id", *_NEXT5)


@query
def next_is_home(spark, sf):
    return schedule.next_is_home(_sides(spark, sf)).select(
        "game_id", "team_id", *[f"next_is_home_{i}" for i in range(1, 6)]
    )


@query
def schedule_simple_next5(spark, sf):
    rows = schedule.schedule_simple(_sides(spark, sf)).select("game_id", "team_id", *_NEXT5)
    return _rounded(rows, "schedule_difficulty_next5")


@query
def schedule_counts(spark, sf):
    return schedule.schedule_counts(_sides(spark, sf)).select(
        "game_id", "team_id", "home_games_next5", "away_games_next5", "b2b_games_next5"
    )


def _strength(sides_df: DataFrame, horizon: int, max_rows: int | None = None) -> DataFrame:
    rows = schedule.schedule_strength(sides_df, horizon, max_rows=max_rows)
    return _rounded(rows, f"schedule_difficulty_next{horizon}").drop("game_date")


@query
def schedule_strength_next5(spark, sf):
    return _strength(_sides(spark, sf), 5)


@query
def schedule_strength_next10(spark, sf):
    return _strength(_sides(spark, sf), 10)


@query
def schedule_strength_split(spark, sf):
    """Strength of schedule with every team cut into lanes."""
    return _strength(_sides(spark, sf), 5, SPLIT_ROWS)


def _sos(spark, sf, max_rows=None):
    # Rounded before ranking: averages differing in the last bit would rank equal teams apart.
    strength = _rounded(schedule.schedule_strength(_sides(spark, sf)), "schedule_difficulty_next5")
    return schedule.sos_rank(strength, max_rows=max_rows).select(
        "team_id", "game_id", "schedule_difficulty_next5", "sos_rank"
    )


@query
def sos_rank(spark, sf):
    return _sos(spark, sf)


@query
def sos_rank_split(spark, sf):
    """The same with the ranked values cut into lanes."""
    return _sos(spark, sf, 4)


# --- dashboard -----------------------------------------------------------------------------------


def _dash(name: str, inputs: Callable, answer: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: answer(inputs(spark, sf))


def _with_strength(spark: SparkSession, sf: str) -> DataFrame:
    return _team(spark, sf, "strength")


_dash("dash_win_rate_by_team", _team, dashboard.win_rate_by_team)
_dash("dash_win_rate_top10", _team, lambda t: dashboard.win_rate_by_team(t, 10))
_dash("dash_avg_points_by_team", _team, dashboard.avg_points_by_team)
_dash("dash_home_away_games", _team, dashboard.home_away_games)
_dash("dash_home_away_wins", _team, dashboard.home_away_wins)
_dash("dash_prob_histogram", _scored, dashboard.probability_histogram)
_dash("dash_prob_histogram_025", _scored, lambda m: dashboard.probability_histogram(m, 0.25))
_dash("dash_prob_histogram_03", _scored, lambda m: dashboard.probability_histogram(m, 0.3))
_dash("dash_form_vs_result_025", _matches, lambda m: dashboard.form_vs_result(m, 0.25))
_dash("dash_win_rate_by_conference", _team, dashboard.win_rate_by_conference)
_dash("dash_rest_days", _team, dashboard.win_rate_by_rest_days)
_dash("dash_pred_accuracy", _scored, dashboard.prediction_accuracy)
_dash("dash_team_ranking", _team, dashboard.team_ranking)
_dash("dash_team_ranking_by_conference", _team, dashboard.team_ranking_by_conference)
_dash("dash_home_win_monthly", _matches, dashboard.home_win_rate_by_month)
_dash("dash_score_diff_hist", _matches, dashboard.score_difference_histogram)
_dash("dash_form_vs_result", _matches, dashboard.form_vs_result)
_dash("dash_calibration", _scored, dashboard.calibration)
_dash("dash_confidence", _scored, dashboard.confidence)
_dash("dash_schedule_by_team", _with_strength, dashboard.schedule_by_team)
_dash("dash_sos_table", _with_strength, dashboard.sos_table)
_dash("dash_next5_home_away", _with_strength, dashboard.next5_home_away)


def _cube(spark: SparkSession, sf: str, schedule_kind: str = "constant") -> DataFrame:
    """The cells of two runs: the first holds faulty rows of its last season, the second takes them
    back and brings that season again and the later ones."""
    path = scratch_path(spark, "cube")
    rows = stored(_team(spark, sf, schedule_kind), "cube-rows")
    faulty = rows.where(F.col("season") == SPLIT_SEASON).withColumns(
        {"team_name": F.lit("faulty"), "avg_points_last5": F.col("avg_points_last5") + 7, "is_home": F.lit(1)}
    )
    early = rows.where(F.col("season") < SPLIT_SEASON).unionByName(faulty)
    cube.write_cells(cube.cells(early), path, FIRST_RUN)
    cube.write_cells(cube.changes(faulty, rows.where(F.col("season") >= SPLIT_SEASON)), path, SECOND_RUN)
    return cube.merged(cube.read_cells(spark, path))


def _cube_strength(spark: SparkSession, sf: str) -> DataFrame:
    return _cube(spark, sf, "strength")


_AHEAD = (cube.schedule_by_team, cube.sos_table, cube.next5_home_away)
for _name, _panel in cube.PANELS.items():
    _dash(
        f"cube_{_name}",
        _cube_strength if _panel in _AHEAD else _cube,
        lambda c, panel=_panel: panel(cube.pick(c)),
    )


@query
def cube_ranking_in_range(spark, sf):
    """The ranking between two days, from the cells of whole months and of the days at the ends."""
    return cube.team_ranking(cube.pick(_cube(spark, sf), start="1996-03-17", end="1999-10-05"))


@query
def cube_cells(spark, sf):
    """All cells by day, added up over the runs: rows, wins and points are sums that lose nothing."""
    made = _cube(spark, sf).where(F.col("level") == cube.DAY)
    return made.select(
        "game_date", "season", "team_name", "conference", "is_home", "rest_days", "rows",
        F.col("is_win__sum").cast("long").alias("wins"),
        F.round(F.col("avg_points_last5__sum").cast("double"), 6).alias("points"),
        F.col("rest_days__known").alias("rested"),
    )


@query
def dash_filtered(spark, sf):
    """Dashboard filters: two seasons, three teams, a date range."""
    picked = dashboard.filtered(
        _team(spark, sf),
        seasons=[1999, 2000],
        teams=["NATION_1", "NATION_2", "NATION_3"],
        start="1999-10-01",
        end="2000-07-01",
    )
    return picked.select("game_id", "team_id", "team_name", "win_rate", "win_rate_last5")


@query
def dash_filtered_matches(spark, sf):
    """The team filter on matches: at home or away."""
    picked = dashboard.filtered(_matches(spark, sf), teams=["NATION_1", "NATION_2"])
    return picked.select("game_id", "home_team_name", "away_team_name")


@query
def dash_last_30_days(spark, sf):
    return dashboard.last_days(_team(spark, sf), "2001-08-01").select(
        "game_id", "game_date", "team_id", "avg_points_last5"
    )


@query
def baseline_home(spark, sf):
    matches = _matches(spark, sf).withColumn(model.LABEL, F.col("home_win"))
    _, test = model.temporal_split(matches, fixtures.CUTOFF)
    return dashboard.baseline_home(test)


@query
def peek_latest(spark, sf):
    return dashboard.peek_latest(_matches(spark, sf)).select(
        "game_id", "game_date", "home_team_name", "away_team_name", "home_win"
    )


# --- model ---------------------------------------------------------------------------------------


@query
def match_features(spark, sf):
    diffs = model.FEATURES[-6:]
    return model.match_features(_matches(spark, sf)).select("game_id", model.LABEL, *diffs)


@query
def imputed_features(spark, sf):
    rows = model.imputed(model.match_features(_matches(spark, sf)))
    return rows.select("game_id", *model.FEATURES)


@query
def temporal_split(spark, sf):
    matches = _matches(spark, sf).withColumn(model.LABEL, F.col("home_win"))
    count = [F.count(F.lit(1)).alias("n"), F.sum(model.LABEL).alias("home_wins")]
    before, after = model.temporal_split(matches, fixtures.CUTOFF)
    return (
        before.agg(*count)
        .withColumn("part", F.lit("train"))
        .unionByName(after.agg(*count).withColumn("part", F.lit("test")))
    )


@query
def auc_rank(spark, sf):
    return _rounded(ranking.rank_auc(_scored(spark, sf), "win_probability_home", "home_win"), "auc")


@query
def auc_rank_split(spark, sf):
    """The same area with the distinct scores cut into lanes."""
    auc = ranking.rank_auc(_scored(spark, sf), "win_probability_home", "home_win", SPLIT_ROWS)
    return _rounded(auc, "auc")


@query
def accuracy(spark, sf):
    return _rounded(model.accuracy(_called(spark, sf), "home_win", "prediction"), "accuracy")


@query
def confusion(spark, sf):
    return model.confusion(_called(spark, sf), "home_win", "prediction")


def _trained(spark: SparkSession, sf: str) -> model.Trained:
    return model.train(_matches(spark, sf), fixtures.CUTOFF)


@query
def rf_predictions(spark, sf):
    """The prediction table."""
    return model.predictions(_trained(spark, sf))


@query
def rf_importance(spark, sf):
    return model.importances(_trained(spark, sf))


@query
def rf_predictions_valid(spark, sf):
    """The prediction table; of the forest's own columns, what must hold for any forest."""
    rows = model.predictions(_trained(spark, sf))
    p = F.col("win_probability_home")
    return rows.select(
        *[c for c in rows.columns if c not in ("win_probability_home", "prediction")],
        p.between(0, 1).alias("probability_valid"),
        ((p > 0.5) == (F.col("prediction") == 1)).alias("prediction_agrees"),
    )


@query
def rf_importance_valid(spark, sf):
    rows = model.importances(_trained(spark, sf))
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return rows.select(
        "feature",
        F.col("importance").between(0, 1).alias("valid"),
        (F.abs(total - 1) < 1e-9).alias("sum_is_one"),
    )


@query
def rf_nodes(spark, sf):
    """The forest as a table of nodes."""
    return model.forest_nodes(_trained(spark, sf))


@query
def rf_score_by_nodes(spark, sf):
    """Every match from the cutoff on, scored by the forest and by joins down its node table."""
    trained = _trained(spark, sf)
    own = model.score_by_nodes(trained.test, model.forest_nodes(trained)).withColumnRenamed("win_probability_home", "by_nodes")
    both = model.predictions(trained).join(own, "game_id", "left")
    agrees = F.abs(F.col("win_probability_home") - F.col("by_nodes")) < 1e-9
    return both.select("game_id", F.coalesce(agrees, F.lit(False)).alias("agrees"))


@query
def rf_evaluation(spark, sf):
    """The evaluators' measures against the rank formula and the share of hits on the same scores."""
    trained = model.train(_matches(spark, sf), fixtures.CUTOFF)
    scores = model.evaluate(trained)
    rows = stored(model.score(trained, trained.test).select(model.LABEL, "win_probability_home", "prediction"), "rf")
    own = ranking.rank_auc(rows, "win_probability_home", model.LABEL).select(
        F.lit("test_auc").alias("measure"), F.col("auc").alias("own")
    )
    own = own.unionByName(
        model.accuracy(rows, model.LABEL, "prediction").select(
            F.lit("test_accuracy").alias("measure"), F.col("accuracy").alias("own")
        )
    )
    value = F.when(F.col("measure") == "test_auc", scores["test_auc"]).otherwise(scores["test_accuracy"])
    # the evaluator draws its curve through 1000 points
    return own.select("measure", (F.abs(F.col("own") - value) < 1e-3).alias("agrees"))


# --- stream --------------------------------------------------------------------------------------


@query
def stream_incremental(spark, sf):
    """Two runs loaded by a stream, one after the other, into the current games."""
    root, table, checkpoint = (scratch_path(spark, n) for n in ("raw", "loads", "offsets"))
    games = fixtures.raw_games(spark, sf)
    season = F.col("season").cast("int")
    fixtures.land_wrapped(games.where(season <= SPLIT_SEASON), f"{root}/{RUN}={FIRST_RUN}")
    load_new_games(spark, root, table, checkpoint)
    corrected = games.where(season >= SPLIT_SEASON).withColumn("status", F.lit("FINAL"))
    fixtures.land_bare(corrected, f"{root}/{RUN}={SECOND_RUN}")
    load_new_games(spark, root, table, checkpoint)
    return current_games(spark, table)


@query
def stream_upsert(spark, sf):
    """Three loads, the last a repetition, into a table that holds one copy of each game."""
    root, table, checkpoint, path = (scratch_path(spark, n) for n in ("raw", "loads", "offsets", "current"))
    current = current_table(path, buckets=16)
    games = fixtures.raw_games(spark, sf)
    season = F.col("season").cast("int")
    fixtures.land_wrapped(games.where(season <= SPLIT_SEASON), f"{root}/{RUN}={FIRST_RUN}")
    load_new_games(spark, root, table, checkpoint, current=current)
    corrected = games.where(season >= SPLIT_SEASON).withColumn("status", F.lit("FINAL"))
    for run in (SECOND_RUN, THIRD_RUN):
        fixtures.land_bare(corrected, f"{root}/{RUN}={run}")
        load_new_games(spark, root, table, checkpoint, current=current)
    return current_games(spark, current)
