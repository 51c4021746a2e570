"""Windows over entity timelines that no hot entity can overload.

A window partitioned by entity alone puts each entity into one task: 30 teams are 30 tasks however
large the cluster, and an entity with a third of all rows is one endless task. ``enter`` therefore
looks whether any entity has more than ``task_rows`` rows. While none has, the plain window is used.
Otherwise the rows are dealt by range, in the order (entity, day, ties), sorted within the partitions
and stored with their place in this order: the ranges of such a shuffle are sampled, so they have to be
used as they came out. Every ``task_rows`` rows of a partition are a *lane*, however the rows crowd on days
or moments. Lanes are as many as rows over the limit, partitions (tasks and files) are not: these follow
``spark.sql.shuffle.partitions`` and the sorting of some million rows in one task, so a small limit
makes many short lanes, not many tasks. Windows go by the place, so lanes agree on the order of rows alike
in entity, day and all ties. Every lane gets, as extra rows, what windows need from the lanes before and after:

* one carry row holding count and totals of all earlier lanes of the entity,
* the last ``before`` rows ahead of it and the first ``after`` rows behind it.

Both are reduced before they are shuffled and made for entities in more than one lane only. Which of
the two ways is taken changes the plan, never the rows; ``task_rows`` decides it.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from leaguelake.scale import DEFAULT_TASK_ROWS, stored, task_rows

LANE, KIND, PLACE = "__lane", "__kind", "__place"
IN_PARTITION = (1 << 33) - 1  # the bits of a place that count the rows of a partition
LANES_PER_TASK = 4  # at least, unless they are long
CARRIED = "__carried_"  # prefix of the carried totals
CARRY_N = CARRIED + "rows"
CARRY, EARLIER, OWN, LATER = 0, 1, 2, 3


@dataclass(frozen=True)
class Timeline:
    """Rows of an entity in order: ``day`` first, then ``ties``."""

    entity: tuple[str, ...]
    day: str
    ties: tuple[str, ...] = ()

    @property
    def order(self) -> list[Column]:
        return [F.col(self.day), *[F.col(c) for c in self.ties]]


@dataclass(frozen=True)
class Lanes:
    """Rows ready for windows, with expressions that mean the same whether or not they were cut."""

    rows: DataFrame
    timeline: Timeline
    split: bool

    @property
    def window(self) -> WindowSpec:
        if not self.split:
            return Window.partitionBy(*self.timeline.entity).orderBy(*self.timeline.order)
        keys = [*self.timeline.entity, LANE]
        return Window.partitionBy(*keys).orderBy(KIND, *_order(self.rows, self.timeline))

    @property
    def is_own(self) -> Column:
        return F.col(KIND) == OWN if self.split else F.lit(True)

    def _visible(self, value: Column) -> Column:
        return F.when(F.col(KIND) != CARRY, value) if self.split else value

    def ordinal(self) -> Column:
        """1 for the entity's first row, 2 for the next, ..."""
        if not self.split:
            return F.row_number().over(self.window).cast("long")
        step = F.when(F.col(KIND) == OWN, 1).when(F.col(KIND) == CARRY, F.col(CARRY_N)).otherwise(0)
        return F.sum(step).over(self.window.rowsBetween(Window.unboundedPreceding, 0))

    def prior_sum(self, value: str) -> Column:
        """Sum over all earlier rows; NULL where there is none."""
        col = F.col(value)
        if self.split:
            col = F.when(F.col(KIND) == OWN, col).when(F.col(KIND) == CARRY, F.col(_carry(value)))
        return F.sum(col).over(self.window.rowsBetween(Window.unboundedPreceding, -1))

    def last_sum(self, value: Column, n: int) -> Column:
        """Sum over the ``n`` rows before this one; NULL where there is none."""
        return F.sum(self._visible(value)).over(self.window.rowsBetween(-n, -1))

    def next_sum(self, value: Column, n: int) -> Column:
        """Sum over the ``n`` rows after this one; NULL where there is none."""
        return F.sum(self._visible(value)).over(self.window.rowsBetween(1, n))

    def previous(self, value: Column) -> Column:
        return F.lag(self._visible(value)).over(self.window)

    def following(self, value: Column, i: int) -> Column:
        return F.lead(self._visible(value), i).over(self.window)

    def leave(self, df: DataFrame) -> DataFrame:
        """Drop the neighbour rows and the helper columns."""
        if not self.split:
            return df
        helpers = [c for c in df.columns if c in (LANE, KIND, PLACE) or c.startswith(CARRIED)]
        return df.where(self.is_own).drop(*helpers)


def enter(
    df: DataFrame,
    timeline: Timeline,
    sums: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    max_rows: int | None = None,
) -> Lanes:
    """Prepare ``df`` for windows along ``timeline``.

    ``sums`` names the columns ``prior_sum`` will be asked for; ``before`` and ``after`` say how many
    neighbouring rows the windows look at. If it has to be cut, ``df`` is read twice: to count its
    entities and to store its lanes.
    """
    limit = max_rows or task_rows(df.sparkSession)
    total = df.count()
    if total <= limit or not _has_hot(df, timeline, limit):
        return Lanes(df, timeline, split=False)
    rows = _dealt(df, timeline, total, limit)
    cut = stored(_cut_entities(rows, timeline, sums), "lanes")
    own = rows.withColumn(KIND, F.lit(OWN))
    extra = [_carries(cut, timeline, sums)]
    if before:
        extra.append(_edges(rows, cut, timeline, before, EARLIER))
    if after:
        extra.append(_edges(rows, cut, timeline, after, LATER))
    for part in extra:
        own = own.unionByName(part, allowMissingColumns=True)
    return Lanes(own, timeline, split=True)


def _carry(value: str) -> str:
    return CARRIED + value


def _matches(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality: rows without an entity form a group that can be hot as well."""
    return functools.reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    )


def _has_hot(df: DataFrame, tl: Timeline, limit: int) -> bool:
    counts = df.groupBy(*tl.entity).agg(F.count(F.lit(1)).alias("n"))
    return not counts.where(F.col("n") > limit).isEmpty()


def _partitions(total: int, limit: int, usual: int) -> int:
    """As many as a shuffle has, fewer for few lanes, more if one would get more rows than a task may sort."""
    lanes, tasks = -(-total // limit), -(-total // max(limit, DEFAULT_TASK_ROWS))
    return max(tasks, min(usual, -(-lanes // LANES_PER_TASK)))


def _dealt(df: DataFrame, tl: Timeline, total: int, limit: int) -> DataFrame:
    """The rows, stored with their place in the order and that of their lane's first row."""
    keys = [F.col(c) for c in tl.entity]
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(_partitions(total, limit, usual), *keys, *tl.order)
    placed = ranged.sortWithinPartitions(*keys, *tl.order).withColumn(PLACE, F.monotonically_increasing_id())
    row = F.col(PLACE).bitwiseAND(F.lit(IN_PARTITION))
    return stored(placed.withColumn(LANE, F.col(PLACE) - row % limit), "dealt")


def _order(rows: DataFrame, tl: Timeline) -> list[Column]:
    return [F.col(PLACE)] if PLACE in rows.columns else tl.order


def _cut_entities(rows: DataFrame, tl: Timeline, sums: Sequence[str]) -> DataFrame:
    """Entity, lane and totals of the entities in several lanes: fewer than two for every lane."""
    totals = rows.groupBy(*tl.entity, LANE).agg(
        F.count(F.lit(1)).alias(CARRY_N), *[F.sum(c).alias(_carry(c)) for c in sums]
    )
    lanes = F.count(F.lit(1)).over(Window.partitionBy(*tl.entity))
    return totals.withColumn("__lanes", lanes).where("__lanes > 1").drop("__lanes")


def _carries(cut: DataFrame, tl: Timeline, sums: Sequence[str]) -> DataFrame:
    """One row per lane with the totals of the entity's earlier lanes."""
    earlier = Window.partitionBy(*tl.entity).orderBy(LANE).rowsBetween(Window.unboundedPreceding, -1)
    return cut.select(
        *tl.entity,
        LANE,
        F.lit(CARRY).alias(KIND),
        F.coalesce(F.sum(CARRY_N).over(earlier), F.lit(0)).alias(CARRY_N),
        *[F.sum(_carry(c)).over(earlier).alias(_carry(c)) for c in sums],
    )


def _edges(rows: DataFrame, cut: DataFrame, tl: Timeline, n: int, kind: int) -> DataFrame:
    """For every lane of a cut entity, the ``n`` rows just before (or just after) it."""
    keys = [*tl.entity, LANE]
    earlier = kind == EARLIER
    payload = [c for c in rows.columns if c not in keys]
    nearest = [c.desc() for c in _order(rows, tl)] if earlier else _order(rows, tl)
    wanted = cut.select(*[F.col(k).alias(f"__c_{k}") for k in keys])
    # row_number <= n is applied on the map side too: n rows per lane and task are shuffled.
    edge = (
        rows.join(wanted, _matches(keys, "__c_"), "left_semi")
        .withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*nearest)))
        .where(F.col("__rank") <= n)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("__rank", *payload))).alias("__edge"))
    )
    # Every lane has at least one row, so n neighbouring lanes hold the n rows looked for.
    lanes = Window.partitionBy(*tl.entity).orderBy(F.col(LANE).desc() if earlier else F.col(LANE))
    near = F.flatten(F.collect_list("__edge").over(lanes.rowsBetween(1, n)))
    return (
        edge.select(*keys, near.alias("__near"))
        .select(*keys, F.explode(F.slice("__near", 1, n)).alias("__row"))
        .select(*keys, F.lit(kind).alias(KIND), *[F.col(f"__row.{c}").alias(c) for c in payload])
    )
