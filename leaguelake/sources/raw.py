"""Landed JSON payloads to typed, renamed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from leaguelake.functions import iso_date, name_key, whole_number
from leaguelake.layout import RUN
from leaguelake.schemas import RAW_GAME, RAW_TEAM, RAW_VENUE, payload

GAMES_WRAPPER = "data"
# what ``read_checked`` adds to the fields of a record
REASON, RAW_TEXT, FILE = "reason", "raw_text", "file"
UNREADABLE, NO_RECORDS, NO_KEY, NO_DATE = "unreadable payload", "no records", "no id", "no date"
UNREADABLE_FIELD = "unreadable field: "
VENUES_WRAPPER = "teams"


def read_payloads(
    spark: SparkSession,
    path: str,
    record: StructType,
    wrapper: str = GAMES_WRAPPER,
    multi_line: bool = False,
) -> DataFrame:
    """Records of all payloads below ``path``.

    A payload is either a bare array of records or an object holding them in ``wrapper``; both kinds
    may be mixed. ``multi_line`` reads one document per file (not splittable); otherwise every line
    is a payload. Reading a table root keeps the run date as column ``dt``.
    """
    raw = spark.read.schema(payload(record, wrapper)).option("multiLine", multi_line).json(path)
    return unwrap(raw, record, wrapper)


def read_checked(
    spark: SparkSession,
    path: str,
    record: StructType,
    key: str,
    wrapper: str = GAMES_WRAPPER,
    multi_line: bool = False,
) -> DataFrame:
    """As ``read_payloads``, but nothing gets lost: see ``unwrap_checked``."""
    pages = spark.read.text(path, wholetext=multi_line)
    return unwrap_checked(pages.withColumn(FILE, F.col("_metadata.file_path")), record, key, wrapper)


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _field(record: Column, field: StructField, path: str = "$") -> tuple[Column, Column]:
    """A field of a parsed record as its type, and whether there is a value that cannot be read as that."""
    path = f"{path}.{field.name}"
    given = F.try_variant_get(record, path, "variant")
    if not isinstance(field.dataType, StructType):
        typed = F.try_variant_get(record, path, field.dataType.simpleString())
        return typed, _present(given) & typed.isNull()
    parts = [_field(record, inner, path) for inner in field.dataType.fields]
    struct = F.struct(*[typed.alias(inner.name) for inner, (typed, _) in zip(field.dataType.fields, parts, strict=True)])
    no_object = _present(given) & F.try_variant_get(record, path, "map<string,variant>").isNull()
    wrong = no_object
    for _, inner_wrong in parts:
        wrong = wrong | inner_wrong
    return F.when(_present(given) & ~no_object, struct), wrong


def unwrap_checked(
    pages: DataFrame, record: StructType, key: str, wrapper: str = GAMES_WRAPPER
) -> DataFrame:
    """All records of the payloads in column ``value``, and a row for every payload that gave none.

    Payloads are parsed without a schema, and the fields of a record are read one by one: a value of the
    wrong type costs neither the other fields nor the text. ``reason`` says why a row is to be set
    aside and is NULL for good records; ``raw_text`` is then the payload as it came, if it has no
    records, and else the record as JSON. Empty pages and blank lines are no fault.
    """
    kept = [c for c in pages.columns if c != "value"]
    fields = record.fields
    page = F.col("__page")
    any_field = F.coalesce(*[F.when(F.try_variant_get(page, f"$.{f.name}", "variant").isNotNull(), True) for f in fields])
    records = F.coalesce(
        F.try_variant_get(page, "$", "array<variant>"),
        F.try_variant_get(page, f"$.{wrapper}", "array<variant>"),
        F.when(any_field, F.array(page)),
    )
    parsed = pages.where("trim(value) <> ''").withColumn("__page", F.try_parse_json("value"))
    found = parsed.select(*kept, "value", page.isNull().alias("__broken"), records.alias("__records"))
    some = found.where(F.coalesce(F.size("__records") > 0, F.lit(True)))
    rows = some.select(
        *kept, "value", "__broken", F.col("__records").isNull().alias("__none"), F.explode_outer("__records").alias("__record")
    )
    one = F.col("__record")
    typed = {f.name: _field(one, f) for f in fields}
    fault = F.when(F.col("__none"), F.when(F.col("__broken"), UNREADABLE).otherwise(NO_RECORDS))
    fault = fault.when(typed[key][0].isNull(), NO_KEY)
    for name, (_, wrong) in typed.items():
        fault = fault.when(wrong, UNREADABLE_FIELD + name)
    text = F.when(F.col("__none"), F.col("value")).otherwise(F.to_json(one))
    checked = rows.select(*kept, *[value.alias(name) for name, (value, _) in typed.items()], fault.alias(REASON), text.alias(RAW_TEXT))
    return checked.withColumn(RAW_TEXT, F.when(F.col(REASON).isNotNull(), F.col(RAW_TEXT)))


def quarantined(checked: DataFrame) -> DataFrame:
    """The rows that were set aside: why, where they came from, and what they were."""
    return checked.where(F.col(REASON).isNotNull()).select(REASON, FILE, RAW_TEXT)


def unwrap(raw: DataFrame, record: StructType, wrapper: str = GAMES_WRAPPER) -> DataFrame:
    """Wrapped and bare records as one flat table, in one pass."""
    fields = record.fieldNames()
    has_value = F.coalesce(*[F.when(F.col(f).isNotNull(), True) for f in fields])
    # inline() of NULL gives no rows: that drops documents which are neither kind.
    records = F.coalesce(F.col(wrapper), F.when(has_value, F.array(F.struct(*fields))))
    kept = [c for c in raw.columns if c not in (*fields, wrapper)]
    return raw.select(*kept, F.inline(records))


def _run_column(df: DataFrame) -> list[Column]:
    return [F.col(RUN)] if RUN in df.columns else []


def format_games(raw: DataFrame) -> DataFrame:
    """Raw games to the fixed games schema; unreadable dates and numbers become NULL.

    What ``read_checked`` added stays.
    """
    return raw.select(
        F.col("id").alias("game_id"),
        iso_date(F.col("date")).alias("game_date"),
        whole_number(F.col("season")).alias("season"),
        F.col("home_team.id").alias("home_team_id"),
        F.col("visitor_team.id").alias("visitor_team_id"),
        whole_number(F.col("home_team_score")).alias("home_team_score"),
        whole_number(F.col("visitor_team_score")).alias("visitor_team_score"),
        F.lower("status").alias("status"),
        *_run_column(raw),
        *_checks(raw),
    )


def _checks(raw: DataFrame) -> list[str]:
    return [c for c in (REASON, RAW_TEXT, FILE) if c in raw.columns]


def format_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("team_id"),
        F.col("full_name").alias("team_name"),
        name_key(F.col("full_name")).alias("team_name_norm"),
        "city",
        "abbreviation",
        "conference",
        "division",
        *_run_column(raw),
        *_checks(raw),
    )


def format_venues(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("idTeam").alias("thesportsdb_team_id"),
        F.col("strTeam").alias("thesportsdb_team_name"),
        name_key(F.col("strTeam")).alias("team_name_norm"),
        F.col("strStadium").alias("venue_name"),
        F.col("strLocation").alias("venue_city"),
        whole_number(F.col("intStadiumCapacity")).alias("venue_capacity"),
        F.col("strWebsite").alias("team_website"),
        F.col("strBadge").alias("team_badge"),
        *_run_column(raw),
        *_checks(raw),
    )


def read_games(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_payloads(spark, path, RAW_GAME, GAMES_WRAPPER, multi_line)


def read_games_checked(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_checked(spark, path, RAW_GAME, "id", GAMES_WRAPPER, multi_line)


def read_teams(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_payloads(spark, path, RAW_TEAM, GAMES_WRAPPER, multi_line)


def read_venues(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_payloads(spark, path, RAW_VENUE, VENUES_WRAPPER, multi_line)


def read_teams_checked(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_checked(spark, path, RAW_TEAM, "id", GAMES_WRAPPER, multi_line)


def read_venues_checked(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_checked(spark, path, RAW_VENUE, "idTeam", VENUES_WRAPPER, multi_line)
