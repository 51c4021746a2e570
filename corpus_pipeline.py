"""The training-data pipeline over ``documents``: five stages, each by one operator.

A stage takes the session, the documents its predecessor kept and the folder of the tables, and
returns a DataFrame; all but the last return the columns of the documents. ``run`` writes what a stage
returns to the shared folder and reads it again for the next one, so no stage is computed twice and a
lost executor costs one stage's tasks. Rows are judged one by one, whatever their ids: NULL and
repeated ids, NULL and empty texts and further columns pass through every stage, and empty tables give
empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leaguelake.llm import decontaminate, jaccard, packing, quality, secrets
from leaguelake.llm.tables import table
from leaguelake.scale import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts; it learns from ``labels``."""
    scores = quality.with_quality(docs, table(spark, sf_dir, "labels"), name="__quality")
    return scores.where(scores["__quality"] >= quality.KEEP_FROM).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the row with the smallest id."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the reported spans masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: a trained network, connected components, alignments and a tokenizer: not for SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
