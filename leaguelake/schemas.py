"""Declared schemas: raw JSON is never inferred, so a scan reads the files once."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_side = StructType([StructField("id", LongType())])

RAW_GAME = StructType(
    [
        StructField("id", LongType()),
        StructField("date", StringType()),
        StructField("season", StringType()),
        StructField("status", StringType()),
        StructField("home_team", _side),
        StructField("visitor_team", _side),
        StructField("home_team_score", StringType()),
        StructField("visitor_team_score", StringType()),
    ]
)

RAW_TEAM = StructType(
    [
        StructField("id", LongType()),
        StructField("full_name", StringType()),
        StructField("city", StringType()),
        StructField("abbreviation", StringType()),
        StructField("conference", StringType()),
        StructField("division", StringType()),
    ]
)

RAW_VENUE = StructType(
    [
        StructField("idTeam", StringType()),
        StructField("strTeam", StringType()),
        StructField("strStadium", StringType()),
        StructField("strLocation", StringType()),
        StructField("intStadiumCapacity", StringType()),
        StructField("strWebsite", StringType()),
        StructField("strBadge", StringType()),
    ]
)

STATE = StructType(
    [
        StructField("last_date", StringType()),
        StructField("last_game_count", LongType()),
        StructField("last_run", StringType()),
    ]
)


def payload(record: StructType, wrapper: str) -> StructType:
    """Fields of a bare record plus the array field a wrapped payload keeps its records in."""
    return StructType([*record.fields, StructField(wrapper, ArrayType(record))])
