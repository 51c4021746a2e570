"""Exports of changes: what an index needs to follow a table, instead of all its documents again.

Every export keeps the id and a content hash of each document in a table in parts. The next one compares
ids and hashes only, writes action lines (gzip) for documents that are new or differ and delete lines for ids
that are gone, and rewrites the parts of the hash table it touched. A changed document is sent whole, by
the same action as a new one: a partial update would keep fields that have become NULL and are left out.

An export has a number above those before it. Lines are written before the hashes, and a repeated number
compares with the export before it, so an export that was cut off or is run twice leaves the same lines.

Defined cases: ids must be there and unique, else nothing is written and the export fails; with several
key columns the id is their JSON array; an empty table deletes all documents; equal tables give no lines.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.scale import stored
from leaguelake.sinks.documents import document
from leaguelake.sinks.parts import PART, PartTable

ID, HASH, KIND = "__id", "__hash", "__kind"
NEW, CHANGED, GONE, FAULTY = "new", "changed", "gone", "faulty"
BROADCAST_IDS = 250_000


@dataclass(frozen=True)
class ChangeExport:
    path: str
    index: str
    key: tuple[str, ...]
    keep_nulls: tuple[str, ...] = ()
    buckets: int = 64

    @property
    def _hashes(self) -> PartTable:
        return PartTable(f"{self.path.rstrip('/')}/hashes", (ID,), self.buckets)

    def _lines(self, kind: str, number: int) -> str:
        return f"{self.path.rstrip('/')}/lines/export={number}/{kind}"

    def _opening(self, action: str) -> str:
        """The start of an action line, up to the id."""
        return f'{{"{action}":{{"_index":{json.dumps(self.index)},"_id":'

    def document_id(self) -> Column:
        parts = [F.col(c).cast("string") for c in self.key]
        return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))

    def write(self, df: DataFrame, number: int) -> None:
        """Write the lines that turn the index as of the export before into ``df``."""
        spark = df.sparkSession
        doc = document(df, self.keep_nulls)
        rows = df.withColumn(ID, self.document_id())
        now = stored(rows.select(ID, F.unhex(F.sha2(doc, 256)).alias(HASH)), "hashes")
        before = self._hashes.read(spark, before=number)
        first = before is None
        if first:
            before = now.limit(0)
        changes = stored(_compared(before.select(ID, HASH), now), "changes")
        if not changes.where(F.col(KIND) == FAULTY).isEmpty():
            raise ValueError(f"documents of {self.index} without an id, or several with one")

        if not first:  # else all documents are new
            sent = changes.where(F.col(KIND).isin(NEW, CHANGED)).select(ID)
            rows = rows.join(_unsorted(sent), ID, "left_semi")  # rows travel, not their documents
        line = F.concat(F.lit(self._opening("index")), _quoted(F.col(ID)), F.lit("}}\n"), doc)
        rows.select(line).write.mode("overwrite").text(self._lines("index", number), compression="gzip")
        line = F.concat(F.lit(self._opening("delete")), _quoted(F.col(ID)), F.lit("}}"))
        gone = changes.where(F.col(KIND) == GONE).select(line)
        gone.write.mode("overwrite").text(self._lines("delete", number), compression="gzip")

        part = self._hashes.part_of()
        touched = {r[PART] for r in changes.select(part.alias(PART)).distinct().collect()}  # at most ``buckets``
        self._hashes.replace(now.where(part.isin(*touched)), touched, number)

    def read(self, spark: SparkSession, number: int) -> DataFrame:
        """The changes of an export: id, and the document or NULL for one that is deleted."""
        opening = self._opening("index")
        pieces = spark.read.option("lineSep", opening).text(self._lines("index", number)).where("value <> ''")
        cut = F.instr("value", "}}\n")
        # an id's own quotes and line breaks are escaped, so the first such end is the action's
        sent = pieces.select(
            _unquoted(F.substr("value", F.lit(1), cut - 1)).alias("id"),
            F.rtrim(F.substr("value", cut + 3), F.lit("\n")).alias("doc"),
        )
        lines = spark.read.text(self._lines("delete", number))
        ending = F.length("value") - F.lit(len(self._opening("delete")) + 2)
        gone = lines.select(
            _unquoted(F.substr("value", F.lit(len(self._opening("delete")) + 1), ending)).alias("id"),
            F.lit(None).cast("string").alias("doc"),
        )
        return sent.unionByName(gone)


def _unsorted(ids: DataFrame) -> DataFrame:
    """Stored ids, to be joined without sorting the other side: its rows are long and would spill."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")


def _quoted(text: Column) -> Column:
    """``text`` as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("i")), {"writeNonAsciiCharacterAsCodePoint": "true"}), r"(?s)^\{\"i\":(.*)\}$", 1)


def _unquoted(text: Column) -> Column:
    return F.from_json(F.concat(F.lit('{"i":'), text, F.lit("}")), "i string")["i"]


def _compared(before: DataFrame, now: DataFrame) -> DataFrame:
    """Ids that differ, and how; one grouping tells repeated ids as well."""
    both = before.select(ID, HASH, F.lit(1).alias("old")).unionByName(now.select(ID, HASH, F.lit(0).alias("old")))
    old = F.col("old") == 1
    grouped = both.groupBy(ID).agg(
        F.max(F.when(old, F.col(HASH))).alias("was"),
        F.max(F.when(~old, F.col(HASH))).alias("is"),
        F.count_if(~old).alias("copies"),
    )
    kind = (
        F.when(F.col(ID).isNull() | (F.col("copies") > 1), FAULTY)
        .when(F.col("was").isNull(), NEW)
        .when(F.col("is").isNull(), GONE)
        .when(F.col("was") != F.col("is"), CHANGED)
    )
    return grouped.select(ID, kind.alias(KIND)).where(F.col(KIND).isNotNull())


def applied(documents: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Documents (id, doc) after ``changes``, as an index would hold them."""
    sent = changes.where(F.col("doc").isNotNull())
    if documents is None:
        return sent
    ids = stored(changes.select("id"), "changed-ids")
    return documents.join(_unsorted(ids), "id", "left_anti").unionByName(sent)


def applied_all(spark: SparkSession, export: ChangeExport, numbers: Sequence[int]) -> DataFrame:
    """Documents after the given exports, one after the other."""
    held = None
    for number in numbers:
        held = applied(held, export.read(spark, number))
    return held
