"""Scalar coercions used by the ingest jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Java reads a letter after a number as its type: ``12F`` or ``5d``.
_NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf(inity)?)$"


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    bare = F.trim(text.cast("string"))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def to_flag(text: Column) -> Column:
    """Text to boolean by meaning, so that ``'false'`` is false."""
    return F.trim(text.cast("string")).try_cast("boolean")


def last_label(name: Column) -> Column:
    """Part after the last dot; the whole string when it has no dot."""
    return F.substring_index(name, ".", -1)


def domain_extension(domain: Column) -> Column:
    """Last label with its dot; empty for a missing or empty domain."""
    return F.when(F.coalesce(domain, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit("."), last_label(domain)))


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
