"""How hard the coming games are: constants, the look-ahead count, and strength of schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.operators.asof import asof_last, daily_last
from leaguelake.operators.dedup import latest
from leaguelake.operators.form import LAST, TOTALS, rest_days, with_form
from leaguelake.operators.lanes import Lanes, Timeline, enter
from leaguelake.operators.ranking import rank_desc
from leaguelake.operators.sides import TEAM_GAMES
from leaguelake.scale import stored

# Fixed values of the difficulty formula.
HORIZON = 5
AWAY_WEIGHT = 0.20
B2B_WEIGHT = 0.20
B2B_DAYS = 1
FORMS_IN_TASK, FORMS_IN_DAY = 500_000, 1_000  # of a team and a day each; a day's are searched one by one


def schedule_constants(df: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The placeholder columns: half the horizon at home, half away, difficulty one."""
    return df.withColumns(
        {
            "home_games_next5": F.lit(horizon / 2),
            "away_games_next5": F.lit(horizon / 2),
            "schedule_difficulty_next5": F.lit(1.0).cast("float"),
        }
    )


def _back_to_back(lanes: Lanes) -> Column:
    return F.coalesce((rest_days(lanes) <= B2B_DAYS).cast("int"), F.lit(0))


def next_is_home(
    sides: DataFrame,
    horizon: int = HORIZON,
    timeline: Timeline = TEAM_GAMES,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``next_is_home_1 .. next_is_home_{horizon}``; NULL past the last game."""
    lanes = enter(sides, timeline, after=horizon, max_rows=max_rows)
    flags = {
        f"next_is_home_{i}": lanes.following(F.col("is_home"), i) for i in range(1, horizon + 1)
    }
    return lanes.leave(lanes.rows.withColumns(flags))


def with_simple(lanes: Lanes, rows: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """``rows`` (of ``lanes``, with more columns) and the look-ahead counts of ``schedule_simple``."""
    home = F.coalesce(lanes.next_sum(F.col("is_home"), horizon), F.lit(0)).cast("int")
    away = F.lit(horizon) - F.col(f"home_games_next{horizon}")
    out = rows.withColumn(f"home_games_next{horizon}", home).withColumn(f"away_games_next{horizon}", away)
    difficulty = (F.col(f"away_games_next{horizon}") * AWAY_WEIGHT + horizon) / horizon
    return out.withColumn(f"schedule_difficulty_next{horizon}", difficulty)


def schedule_simple(
    sides: DataFrame,
    horizon: int = HORIZON,
    timeline: Timeline = TEAM_GAMES,
    max_rows: int | None = None,
) -> DataFrame:
    """Look-ahead counts where every game of the horizon that is not at home counts as away.

    Games missing at the end of the schedule therefore count as away games.
    """
    lanes = enter(sides, timeline, after=horizon, max_rows=max_rows)
    return lanes.leave(with_simple(lanes, lanes.rows, horizon))


def schedule_counts(
    sides: DataFrame,
    horizon: int = HORIZON,
    timeline: Timeline = TEAM_GAMES,
    max_rows: int | None = None,
) -> DataFrame:
    """Home, away and back-to-back games among the next ``horizon`` games there are."""
    lanes = enter(sides, timeline, before=1, after=horizon, max_rows=max_rows)
    rows = lanes.rows.withColumn("is_b2b", _back_to_back(lanes))
    flags = {"home": F.col("is_home"), "away": 1 - F.col("is_home"), "b2b": F.col("is_b2b")}
    counts = {
        f"{name}_games_next{horizon}": F.coalesce(lanes.next_sum(flag, horizon), F.lit(0)).cast("int")
        for name, flag in flags.items()
    }
    return lanes.leave(rows.withColumns(counts))


ROW, COMING, WEIGHTS = "__row", "__coming", "__weights"
_GAME = ("opponent_id", "is_home", "is_b2b")


def with_coming(lanes: Lanes, rows: DataFrame, horizon: int) -> DataFrame:
    """``rows`` with ``is_b2b`` and the coming games in order; past the schedule's end they are NULL."""
    games = [
        F.struct(*[lanes.following(F.col(c), i).alias(c) for c in _GAME]) for i in range(1, horizon + 1)
    ]
    return rows.withColumn("is_b2b", _back_to_back(lanes)).withColumn(COMING, F.array(*games))


def weighed(ahead: DataFrame, form: str, horizons: Sequence[int]) -> DataFrame:
    """Add the counts and the difficulty of the next games for every horizon, and drop the games.

    ``ahead`` must be stored: it is read for the forms, the lookups and the result. Forms are as many as
    teams times days. While these are few, a row is joined with all forms of its day and looks its coming
    games up there. Otherwise all coming games are looked up in one join and folded into one row before
    they return, whatever the horizon. Both add up in the order of the games, so every run does so alike.
    """
    numbered = stored(ahead.withColumn(ROW, F.monotonically_increasing_id()), "ahead")
    # One row per team and day, and the distinct days it is asked for.
    known = daily_last(numbered, "team_id", "game_date", form, "game_id")
    probes = numbered.select("game_date", F.explode(F.col(COMING)["opponent_id"]).alias("team_id"))
    forms = stored(asof_last(probes.where("team_id IS NOT NULL"), known, "team_id", "game_date", form), "forms")
    found = forms.where(F.col(form).isNotNull()).toDF("opponent_id", "game_date", "__form")
    by_day = found.groupBy("game_date").agg(F.count(F.lit(1)).alias("n"))
    total, most = by_day.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    few = total <= FORMS_IN_TASK and most <= FORMS_IN_DAY
    rows = _looked_up(numbered, found) if few else _joined(numbered, found, max(horizons))
    columns = {}
    for h in horizons:
        columns |= {f"{name}_games_next{h}": _count(flag, h) for name, flag in _FLAGS.items()}
        columns[f"schedule_difficulty_next{h}"] = _mean_weight(h)
    return rows.withColumns(columns).drop(ROW, COMING, WEIGHTS)


def _weight(form: Column, game: Column) -> Column:
    return form * (1 + AWAY_WEIGHT * (1 - game["is_home"])) * (1 + B2B_WEIGHT * game["is_b2b"])


def _looked_up(numbered: DataFrame, forms: DataFrame) -> DataFrame:
    """The weights of the coming games in order, NULL without a form, from the forms of each row's day."""
    entry = F.struct("opponent_id", "__form")
    days = forms.groupBy("game_date").agg(F.map_from_entries(F.collect_list(entry)).alias("__forms"))
    rows = numbered.join(F.broadcast(stored(days, "days")), "game_date", "left")
    weights = F.transform(COMING, lambda g: _weight(F.try_element_at("__forms", g["opponent_id"]), g))
    return rows.withColumn(WEIGHTS, weights).drop("__forms")


def _joined(numbered: DataFrame, forms: DataFrame, within: int) -> DataFrame:
    """The same by one join, for any number of forms."""
    games = numbered.select(ROW, "game_date", F.posexplode(COMING).alias("i", "game"))
    games = games.withColumn("opponent_id", F.col("game.opponent_id")).where("opponent_id IS NOT NULL")
    found = games.join(forms, ["opponent_id", "game_date"]).select(ROW, "i", _weight(F.col("__form"), F.col("game")).alias("w"))
    # a number for each place and not a list: a task adds up as many rows as it gets
    places = [F.max(F.when(F.col("i") == i, F.col("w"))).alias(f"__{i}") for i in range(within)]
    rows = numbered.join(found.groupBy(ROW).agg(*places), ROW, "left")
    names = [f"__{i}" for i in range(within)]
    return rows.withColumn(WEIGHTS, F.array(*names)).drop(*names)


_FLAGS = {
    "home": lambda g: g["is_home"],
    "away": lambda g: 1 - g["is_home"],
    "b2b": lambda g: g["is_b2b"],
}


def _count(flag, horizon: int) -> Column:
    games = F.slice(COMING, 1, horizon)
    return F.aggregate(games, F.lit(0), lambda n, g: n + F.coalesce(flag(g), F.lit(0)))


def _mean_weight(horizon: int) -> Column:
    """In the order of the games, so that every run adds up alike."""
    near = F.filter(F.slice(WEIGHTS, 1, horizon), F.isnotnull)
    total = F.aggregate(near, F.lit(0.0), lambda s, w: s + w)
    return F.when(F.size(near) > 0, total / F.size(near))


def schedule_strength(
    sides: DataFrame,
    horizon: int = HORIZON,
    timeline: Timeline = TEAM_GAMES,
    max_rows: int | None = None,
) -> DataFrame:
    """Average difficulty of the next ``horizon`` games, per game and team.

    A coming game weighs its opponent's last-five win rate, as last known on the date of the current
    game, times 1.2 if away and times 1.2 if it is the second of a back-to-back.

    Returns one row per (game_id, team_id) with the counts of ``schedule_counts``.
    """
    lanes = enter(sides, timeline, before=LAST, after=horizon, max_rows=max_rows)
    form = lanes.last_sum(F.col("is_win"), LAST) / F.lit(LAST)
    keys = ["game_id", "team_id", "game_date"]
    rows = with_coming(lanes, lanes.rows.withColumn("form", form), horizon)
    ahead = lanes.leave(rows).select(*keys, "form", COMING)
    names = [f"{name}_games_next{horizon}" for name in _FLAGS]
    return weighed(ahead, "form", [horizon]).select(*keys, *names, f"schedule_difficulty_next{horizon}")


def form_and_strength(
    sides: DataFrame,
    horizons: Sequence[int] = (HORIZON, 2 * HORIZON),
    timeline: Timeline = TEAM_GAMES,
    max_rows: int | None = None,
) -> DataFrame:
    """``team_form`` and ``schedule_strength`` for several horizons from one pass over the timelines."""
    lanes = enter(sides, timeline, TOTALS, LAST, max(horizons), max_rows)
    ahead = lanes.leave(with_coming(lanes, with_form(lanes), max(horizons)))
    return weighed(ahead, f"win_rate_last{LAST}", horizons)


def sos_rank(strength: DataFrame, horizon: int = HORIZON, max_rows: int | None = None) -> DataFrame:
    """Teams by the difficulty ahead of their latest game that has one; rank 1 is the hardest."""
    value = f"schedule_difficulty_next{horizon}"
    current = latest(
        strength.where(F.col(value).isNotNull() & F.col("team_id").isNotNull()),
        ["team_id"],
        [F.col("game_date").desc(), F.col("game_id").desc()],
    )
    return rank_desc(stored(current, "current"), value, "sos_rank", max_rows=max_rows)
