"""One query per operator over its whole table, and the SQL that answers the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leaguelake.llm.centroids import clustered, clusters_sql
from leaguelake.llm.decontaminate import contaminated
from leaguelake.llm.jaccard import near_duplicates
from leaguelake.llm.langid import predicted
from leaguelake.llm.licenses import with_licenses
from leaguelake.llm.manifest import digests, manifest_sql
from leaguelake.llm.packing import packed
from leaguelake.llm.quality import scored
from leaguelake.llm.repetition import with_repetition
from leaguelake.llm.secrets import scan, scan_sql
from leaguelake.llm.sharding import sharded
from leaguelake.llm.tables import table
from leaguelake.llm.urls import judged
from leaguelake.llm.warc import ROUND_TRIP_SQL, round_trip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark, sf):
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_quality(spark, sf):
    return scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_repetition(spark, sf):
    return with_repetition(table(spark, sf, "documents"))


@query
def op4_urls(spark, sf):
    return judged(table(spark, sf, "pages"))


@query
def op5_credentials(spark, sf):
    return scan(table(spark, sf, "documents"))


ORACLE["op5_credentials"] = scan_sql()


@query
def op6_licenses(spark, sf):
    return with_licenses(table(spark, sf, "documents")).drop("detections")


@query
def op7_sharding(spark, sf):
    return sharded(table(spark, sf, "documents"))


@query
def op8_warc(spark, sf):
    return round_trip(table(spark, sf, "pages"), stable=True)


ORACLE["op8_warc"] = ROUND_TRIP_SQL


@query
def op9_packing(spark, sf):
    return packed(table(spark, sf, "documents"))


@query
def op10_jaccard(spark, sf):
    found = near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op11_language(spark, sf):
    return predicted(table(spark, sf, "documents"))


@query
def op12_manifest(spark, sf):
    return digests(table(spark, sf, "documents"))


ORACLE["op12_manifest"] = manifest_sql()


@query
def op13_centroids(spark, sf):
    return clustered(table(spark, sf, "embeddings"))


ORACLE["op13_centroids"] = clusters_sql()
