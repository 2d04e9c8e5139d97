"""Column cleaning applied between reading and loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions.dates import parse_timestamp
from subledger.functions.scalars import to_number


def fill_sentinel(df: DataFrame, value, as_string: bool = False) -> DataFrame:
    """Nulls of every column replaced by one value.

    By default only columns of a matching type are filled. With ``as_string``
    all columns become text first, so the sentinel reaches each of them.
    """
    if not as_string:
        return df.fillna(value)
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit(str(value))).alias(c) for c in df.columns])


def fill_column(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))


def value_to_null(df: DataFrame, name: str, value) -> DataFrame:
    """One value of a column turned into null."""
    return df.withColumn(name, F.nullif(F.col(name), F.lit(value)))


def clean_strings(df: DataFrame) -> DataFrame:
    """NUL characters removed and invalid UTF-8 replaced in text columns."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([clean_text(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def clean_text(text: Column) -> Column:
    return F.replace(F.make_valid_utf8(text), F.lit("\x00"), F.lit(""))


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns that exist as doubles; what is no number is null."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})


def normalise_timestamps(df: DataFrame, columns: Sequence[str], as_date: bool = False) -> DataFrame:
    """The named columns that exist as timestamps (or dates), bad text as null."""
    parsed = {}
    for c in columns:
        if c in df.columns:
            is_text = isinstance(df.schema[c].dataType, T.StringType)
            ts = parse_timestamp(F.col(c)) if is_text else F.col(c).cast("timestamp")
            parsed[c] = ts.cast("date") if as_date else ts
    return df.withColumns(parsed) if parsed else df


def rename_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Export headers such as ``Rate Plan: ID`` to column names, where present."""
    return df.withColumnsRenamed({old: new for old, new in labels.items() if old in df.columns})
