"""Form kept up to date: a load recomputes the rows from the first changed month of a team on.

Three tables in parts lie below one folder: the games by id, the team rows with form by team and month,
and the marks, which hold for every team and month what the team's later rows need: the number of games
and the totals up to the month's end and the last rows before it. An update looks up the old copies of its
games, takes for each team the first month in which a game was, or now is, and reads the mark before it
and the team's rows from it on. A game that moves to another day, or gets other teams, leaves its old place.

Each table is replaced by one manifest, under the update's number; an update that broke off is repeated
under that number and starts again from the tables before it. Games carry ids, the newest copy of one
counts, and a batch has one copy of each (``latest_run``). Games without a date come before all others,
as in a window; teams without an id are one team. A team with more rows to recompute than one task
may hold (``task_rows``) is recomputed from its first month on, where ``enter`` cuts its rows into lanes.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.operators.form import LAST, TOTALS, with_form
from leaguelake.operators.lanes import (
    CARRIED,
    CARRY,
    CARRY_N,
    EARLIER,
    KIND,
    LANE,
    OWN,
    Lanes,
    enter,
)
from leaguelake.operators.sides import TEAM_GAMES, side_split
from leaguelake.scale import stored, task_rows
from leaguelake.sinks.parts import PART, PartTable

MONTH, FIRST, TAIL, SEEN = "month", "first_month", "tail", "seen"
UNDATED = "0001-01-01"
NEAR = ("game_id", "game_date", *TOTALS)  # what windows read of a neighbouring row
GAME = (
    "game_id",
    "game_date",
    "season",
    "home_team_id",
    "visitor_team_id",
    "home_team_score",
    "visitor_team_score",
)


def _month() -> Column:
    return F.coalesce(F.trunc("game_date", "month"), F.lit(UNDATED).cast("date"))


def _pairs(rows: DataFrame, pairs: DataFrame, how: str, months: Column | None = None) -> DataFrame:
    """Rows of ``pairs``' teams and months (or of none of them), a missing team being a team."""
    same = rows["team_id"].eqNullSafe(pairs["team_id"])
    return rows.join(pairs, same & (rows[MONTH] == pairs[MONTH] if months is None else months), how)


def _plus(before: str, own: str) -> Column:
    """Sum of two values of which either may be missing."""
    return F.when(
        F.col(before).isNotNull() | F.col(own).isNotNull(),
        F.coalesce(before, F.lit(0)) + F.coalesce(own, F.lit(0)),
    )


@dataclass(frozen=True)
class FormTable:
    path: str
    buckets: int = 64

    def _part_table(self, name: str, *key: str) -> PartTable:
        return PartTable(f"{self.path.rstrip('/')}/{name}", key, self.buckets)

    @property
    def games(self) -> PartTable:
        return self._part_table("games", "game_id")

    @property
    def rows(self) -> PartTable:
        return self._part_table("rows", "team_id", MONTH)

    @property
    def marks(self) -> PartTable:
        return self._part_table("marks", "team_id")

    def read(self, spark: SparkSession) -> DataFrame:
        """Team rows with form, as ``team_form`` gives them for all games."""
        rows = self.rows.read(spark)
        if rows is None:
            raise RuntimeError(f"no game was loaded into {self.path}")
        return rows.drop(MONTH)

    def update(self, games: DataFrame, number: int, max_rows: int | None = None) -> None:
        """Bring ``games``, new ones and corrected copies, into the table as update ``number``."""
        spark = games.sparkSession
        limit = max_rows or task_rows(spark)
        new = stored(games.select(*GAME), "form-games")
        old = self.games.read(spark, _parts(new, self.games), number)
        copies = new if old is None else new.unionByName(old.drop(SEEN).join(new, "game_id", "left_semi"))
        sides = side_split(new).withColumn(MONTH, _month())
        changed = side_split(copies).withColumn(MONTH, _month())
        first = stored(changed.groupBy("team_id").agg(F.min(MONTH).alias(FIRST)), "form-first")
        marked = self.marks.read(spark, _parts(first, self.marks), number)
        suffix, pairs, bystanders, touched = self._suffix(spark, new, sides, first, marked, number)
        hot = suffix.groupBy("team_id").count().where(F.col("count") > limit)
        if not hot.isEmpty():
            whole = hot.select("team_id", F.lit(True).alias("whole")).withColumnRenamed("team_id", "hot_id")
            start = F.when(F.col("whole"), F.lit(UNDATED).cast("date")).otherwise(F.col(FIRST))
            joined = first.join(whole, F.col("team_id").eqNullSafe(F.col("hot_id")), "left")
            first = stored(joined.select("team_id", start.alias(FIRST)), "form-first")
            suffix, pairs, bystanders, touched = self._suffix(spark, new, sides, first, marked, number)
        formed = stored(_formed(suffix, first, marked, limit), "form-rows")
        marks = _marks(formed)
        formed = formed.drop(TAIL)
        if bystanders is not None:
            formed = formed.unionByName(bystanders)
        if marked is not None:
            marks = marks.unionByName(_pairs(marked, pairs, "left_anti"))
        self.rows.replace(formed, touched, number)
        self.marks.replace(marks, _parts(first, self.marks), number)
        self.games.upsert(new.withColumn(SEEN, F.lit(number).cast("long")), [F.col(SEEN).desc()], number)

    def _suffix(self, spark, new, sides, first, marked, number):
        """Rows to recompute, their teams and months, other rows of the same parts, and these parts."""
        pairs = sides.select("team_id", MONTH)
        if marked is not None:
            later = F.col(f"m.{MONTH}") >= F.col(f"f.{FIRST}")
            same = F.col("m.team_id").eqNullSafe(F.col("f.team_id"))
            known = marked.alias("m").join(first.alias("f"), same & later, "left_semi")
            pairs = pairs.union(known.select("team_id", MONTH))
        pairs = stored(pairs.distinct(), "form-pairs")
        touched = _parts(pairs, self.rows)
        old = self.rows.read(spark, touched, number)
        if old is None:
            return sides, pairs, None, touched
        stay = _pairs(old, pairs, "left_semi").select(sides.columns)
        stay = stay.join(new.select("game_id"), "game_id", "left_anti")
        return sides.unionByName(stay), pairs, _pairs(old, pairs, "left_anti"), touched


def _parts(rows: DataFrame, table: PartTable) -> set[int]:
    """The parts of ``table`` that ``rows`` fall in: at most its number of parts."""
    return {r[PART] for r in rows.select(table.part_of().alias(PART)).distinct().collect()}


def _formed(suffix: DataFrame, first: DataFrame, marked: DataFrame | None, limit: int) -> DataFrame:
    """``suffix`` with form; the last row of a month carries the rows its mark needs."""
    before = None if marked is None else _last_marks(marked, first)
    if before is None or before.isEmpty():
        lanes = enter(suffix, TEAM_GAMES, TOTALS, LAST, max_rows=limit)
    else:
        # whole timelines have no mark and may be long; the others fit a task
        fits = suffix.join(before, suffix["team_id"].eqNullSafe(before["team_id"]), "left_semi")
        rest = suffix.join(before, suffix["team_id"].eqNullSafe(before["team_id"]), "left_anti")
        behind = _with_tails(_entered(fits, before))
        return behind.unionByName(_with_tails(enter(rest, TEAM_GAMES, TOTALS, LAST, max_rows=limit)))
    return _with_tails(lanes)


def _last_marks(marked: DataFrame, first: DataFrame) -> DataFrame:
    """Of every team the mark before the first month to recompute."""
    same = F.col("m.team_id").eqNullSafe(F.col("f.team_id"))
    ahead = marked.alias("m").join(first.alias("f"), same & (F.col(f"m.{MONTH}") < F.col(FIRST)), "left_semi")
    newest = F.max_by(F.struct(*[c for c in marked.columns if c != "team_id"]), MONTH)
    return stored(ahead.groupBy("team_id").agg(newest.alias("mark")).select("team_id", "mark.*"), "form-marks")


def _entered(suffix: DataFrame, before: DataFrame) -> Lanes:
    """The suffix behind its marks, as one lane a team."""
    lane = F.lit(0).cast("long").alias(LANE)
    carry = before.select(
        "team_id", lane, F.lit(CARRY).alias(KIND), CARRY_N, *[CARRIED + c for c in TOTALS]
    )
    near = before.select("team_id", lane, F.lit(EARLIER).alias(KIND), F.inline(TAIL))
    parts = (suffix.withColumns({LANE: F.lit(0).cast("long"), KIND: F.lit(OWN)}), carry, near)
    union = functools.partial(DataFrame.unionByName, allowMissingColumns=True)
    return Lanes(functools.reduce(union, parts), TEAM_GAMES, split=True)


def _with_tails(lanes: Lanes) -> DataFrame:
    near = F.struct(*NEAR)
    if lanes.split:
        near = F.when(F.col(KIND) != CARRY, near)
    tail = F.collect_list(near).over(lanes.window.rowsBetween(1 - LAST, 0))
    next_month = lanes.following(F.col(MONTH), 1)
    ends = next_month.isNull() | (next_month != F.col(MONTH))
    return lanes.leave(with_form(lanes).withColumn("__ends", ends).withColumn(TAIL, tail)).withColumn(
        TAIL, F.when(F.col("__ends"), F.col(TAIL))
    ).drop("__ends")


def _marks(formed: DataFrame) -> DataFrame:
    """Team, month, and what later rows need, from the month's last row."""
    last = F.struct(
        F.col("game_number").alias(CARRY_N),
        *[_plus(f"{c}_cum", c).alias(CARRIED + c) for c in TOTALS],
        F.col(TAIL),
    )
    ends = formed.where(F.col(TAIL).isNotNull())
    newest = F.max_by(last, F.struct("game_date", "game_id"))
    return ends.groupBy("team_id", MONTH).agg(newest.alias("mark")).select("team_id", MONTH, "mark.*")
