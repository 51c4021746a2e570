"""The test tables read as a league: orders are games, nations are teams, suppliers own venues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = "2000-01-01"

# The tables' columns; declared, so that no job has to read a file footer first.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    played = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return played.selectExpr(
        "o_orderkey AS game_id",
        "CAST(o_orderdate AS DATE) AS game_date",
        "CAST(YEAR(o_orderdate) AS INT) AS season",
        "CAST(c_nationkey AS INT) AS home_team_id",
        "CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS INT) AS visitor_team_id",
        "CAST(80 + CAST(FLOOR(o_totalprice) AS BIGINT) % 61 AS INT) AS home_team_score",
        "CAST(80 + (o_custkey * 7 + o_orderkey * 13) % 59 AS INT) AS visitor_team_score",
        "LOWER(o_orderstatus) AS status",
    )


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games as the API spells them: ISO dates, nested teams, upper-case status."""
    return games(spark, sf_dir).select(
        F.col("game_id").alias("id"),
        F.concat(F.col("game_date").cast("string"), F.lit("T00:00:00.000Z")).alias("date"),
        F.col("season").cast("string").alias("season"),
        F.upper("status").alias("status"),
        F.struct(F.col("home_team_id").cast("long").alias("id")).alias("home_team"),
        F.struct(F.col("visitor_team_id").cast("long").alias("id")).alias("visitor_team"),
        F.col("home_team_score").cast("string").alias("home_team_score"),
        F.col("visitor_team_score").cast("string").alias("visitor_team_score"),
    )


def raw_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, n) for n in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id",
        "n_name AS full_name",
        "n_name AS city",
        "concat('T', CAST(n_nationkey AS STRING)) AS abbreviation",
        "r_name AS conference",
        "concat(r_name, '-', CAST(n_nationkey % 2 AS STRING)) AS division",
    )


def raw_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One venue per nation that has a supplier, with the name written differently.

    Every seventh is spelled so that it matches no team.
    """
    supplier, nation = (table(spark, sf_dir, n) for n in ("supplier", "nation"))
    first = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k"))
    return (
        first.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "CAST(k AS STRING) AS idTeam",
            "concat(CASE WHEN n_nationkey % 7 = 0 THEN 'Old ' ELSE '  ' END, "
            "replace(n_name, '_', ' - '), '! ') AS strTeam",
            "concat('Arena ', CAST(k AS STRING)) AS strStadium",
            "n_name AS strLocation",
            "CASE WHEN k % 5 = 0 THEN 'n/a' ELSE CAST(10000 + k * 37 AS STRING) END "
            "AS intStadiumCapacity",
            "concat('https://venue.example/', CAST(k AS STRING)) AS strWebsite",
            "CAST(NULL AS STRING) AS strBadge",
        )
    )


# --- landing: raw JSON runs written for the source queries -------------------------------------

DOCUMENT_ROWS = 20_000  # records of one multi-line document
PAGE_ROWS = 100  # records of one page


def _grouped(records: DataFrame, rows: int) -> DataFrame:
    """Documents of at most ``rows`` records: ids are unique, so a block of ids is bounded."""
    block = F.floor(F.col("id") / F.lit(rows)).alias("block")
    return records.groupBy(block).agg(F.collect_list(F.struct(*records.columns)).alias("data"))


def land_wrapped(records: DataFrame, path: str, wrapper: str = "data", rows: int = PAGE_ROWS) -> None:
    """One ``{"data": [...], "meta": {...}}`` page per line."""
    page = F.struct(
        F.col("data").alias(wrapper),
        F.struct((F.col("block") + 1).alias("next_cursor")).alias("meta"),
    )
    _grouped(records, rows).select(F.to_json(page)).write.text(path)


def land_bare(records: DataFrame, path: str, rows: int = PAGE_ROWS) -> None:
    """One ``[...]`` per line."""
    _grouped(records, rows).select(F.to_json("data")).write.text(path)


def land_documents(records: DataFrame, path: str, wrapper: str = "data") -> None:
    """One multi-line document per file."""
    document = F.to_json(F.struct(F.col("data").alias(wrapper)), {"pretty": "true"})
    (
        _grouped(records, DOCUMENT_ROWS)
        .select(document)
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
