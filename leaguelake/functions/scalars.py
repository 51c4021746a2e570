"""Cleaning and arithmetic helpers; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Join key for names spelled differently by two sources: lower-case letters and digits only."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")


def iso_date(text: Column) -> Column:
    """Date of an ISO string, with or without a time part; unreadable text gives NULL."""
    return text.try_cast("date")


def whole_number(value: Column) -> Column:
    """Integer, or NULL where the raw value is not one (ANSI mode would fail the job)."""
    return value.try_cast("int")


def beats(scored: Column, conceded: Column) -> Column:
    """1 when ``scored`` is higher, otherwise 0: ties and missing scores count as no win."""
    return F.when(scored > conceded, 1).otherwise(0)


def ratio(total: Column, n: Column) -> Column:
    """``total / n``, NULL when ``n`` is zero."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def difference_or_zero(a: Column, b: Column) -> Column:
    """``a - b``, or 0.0 when either is missing."""
    return F.coalesce(a - b, F.lit(0.0))
