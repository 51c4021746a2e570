"""Column expressions shared by the operators."""

from leaguelake.functions.scalars import (
    beats,
    difference_or_zero,
    iso_date,
    name_key,
    ratio,
    whole_number,
)

__all__ = ["beats", "difference_or_zero", "iso_date", "name_key", "ratio", "whole_number"]
