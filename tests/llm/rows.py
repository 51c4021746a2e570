"""Small tables of awkward rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]) -> DataFrame:
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame(
        [(i, t, "en", None, None if t is None else len(t)) for i, t in rows], SCHEMA
    ).repartition(3)


def awkward() -> list[tuple[int | None, str | None]]:
    """NULLs, empty and long texts, ties, repeated rows, separators that are not ASCII spaces."""
    prose = " ".join(f"word{i * 7 % 101} Other{i % 13}" for i in range(300))
    return [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, "one"),
        (5, "one two three four"),
        (6, "one two three four"),
        (6, "one two three four"),
        (7, prose),
        (8, prose + " tail"),
        (9, "a b c d e " * 2000),
        (10, "line one here\nline two\nline one here\n\n\nline one here\n"),
        (11, "Released under the MIT License. ünïcödé ××× #tag <b> 100%"),
        (12, "x" * 5000),
        (13, "no break space\x1cend " * 5),
        (None, "a row without an id " * 3),
        (14, "da da da da da da da da da da da da"),
        (15, "\n"),
        (16, "GNU General Public License, version 3; the general  public-license! Apache License, Version 2.0"),
    ]
