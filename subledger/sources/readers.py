"""Landed files and tables as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions.dates import as_date


#: Fixed values. The marker tells a null from an empty text in files written
#: here, and is a private-use character that texts don't hold; a field that is
#: empty without quotes is null as well.
CSV_OPTIONS = {"header": True, "escape": '"', "nullValue": "\ue000", "emptyValue": ""}

BAD_ROW = "_bad_row"


def _by_header(spark: SparkSession, path: str, options: Mapping[str, object]) -> dict[tuple[str, ...], list[str]]:
    """The files of an export by their header line; one line of each is read."""
    files = spark.read.text(path).inputFiles()
    # Names come back encoded; Spark takes them as they are.
    files = sorted(f if urlparse(f).scheme == "" else unquote(f) for f in files)

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**options).csv(file).columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(8) as pool:
        for file, names in zip(files, pool.map(header, files), strict=True):
            if names:
                groups.setdefault(names, []).append(file)
    return groups


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
    bad_rows: str = "fail",
) -> DataFrame:
    """CSV export with header lines; columns are told by their names.

    Files may have their columns in another order, or columns that the schema
    lacks, which are left out; a file without a column of the schema is an
    error. Without a schema all columns of all files are text, null where a
    file lacks one. Quoted fields may hold line breaks, so a file is read by
    one task; with ``multiline=False`` files without such fields are split
    between tasks. A row that doesn't fit the schema fails the read, or with
    ``bad_rows='keep'`` is kept with its text in the column ``_bad_row``.
    """
    if bad_rows not in ("fail", "keep"):
        raise ValueError("bad_rows must be 'fail' or 'keep'")
    options = {**CSV_OPTIONS, "multiLine": multiline}
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad = [T.StructField(BAD_ROW, T.StringType())] if bad_rows == "keep" and wanted is not None else []
    parts = []
    for names, files in _by_header(spark, path, options).items():
        kinds = {} if wanted is None else {f.name: f.dataType for f in wanted}
        if missing := [n for n in kinds if n not in names]:
            raise ValueError(f"{files[0]} lacks the columns {', '.join(missing)}")
        kind = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names] + bad)
        reader = spark.read.options(**options, mode="PERMISSIVE" if bad else "FAILFAST").schema(kind)
        if bad:
            reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
        rows = reader.csv(files)
        parts.append(rows if wanted is None else rows.select(*(f"`{f.name}`" for f in [*wanted.fields, *bad])))
    if not parts:
        return spark.createDataFrame([], T.StructType([*(wanted.fields if wanted else []), *bad]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _misfits(value: Column, kind: T.DataType, path: str = "$") -> Column:
    """Whether a variant, or anything in it that a type names, is of another kind."""
    found = F.try_variant_get(value, path, "variant")
    there = F.coalesce(found.isNotNull() & ~F.is_variant_null(found), F.lit(False))
    if isinstance(kind, T.StructType):
        out = there & F.try_variant_get(found, "$", "struct<_:string>").isNull()
        for f in kind.fields:
            out = out | _misfits(value, f.dataType, f"{path}['{f.name}']")
        return out
    return there & F.try_variant_get(found, "$", kind.simpleString()).isNull()


def _documents(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("_text"), F.try_parse_json("value").alias("_document"))


def _record_type(record: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(record) if isinstance(record, str) else record


def read_records(spark: SparkSession, path: str, record: T.StructType | str, bad_records: str = "fail") -> DataFrame:
    """JSON documents, each with a ``records`` list, as one row per record.

    One document per line; files split between tasks, and each document is
    parsed once. A line that is no document with such a list, an element that
    is no object, and a field of another kind than ``record`` names fail the
    read; with ``bad_records='keep'`` they are rows of :func:`unread_records`,
    and here the line and the element have no row and the field is null.
    """
    if bad_records not in ("fail", "keep"):
        raise ValueError("bad_records must be 'fail' or 'keep'")
    kind = _record_type(record)
    documents = _documents(spark, path)
    if bad_records == "fail":
        records = F.try_variant_get("_document", "$.records", "array<variant>")
        text = F.concat(F.lit("can't read as records: "), F.substring("_text", 1, 200))
        records = F.when(_no_list(), F.raise_error(text).cast("array<variant>")).otherwise(records)
        rows = documents.select("_text", F.explode(records).alias("_record"))
        found = F.when(_unfit_record(kind), F.raise_error(text).cast("variant")).otherwise(F.col("_record"))
        return rows.select(F.try_variant_get(found, "$", kind.simpleString()).alias("_r")).select("_r.*")
    records = F.try_variant_get("_document", "$.records", f"array<{kind.simpleString()}>")
    rows = documents.select(F.explode(records).alias("_r"))
    return rows.where(F.col("_r").isNotNull()).select("_r.*")


def _no_list() -> Column:
    return F.try_variant_get("_document", "$.records", "array<variant>").isNull()


def _unfit_record(kind: T.StructType) -> Column:
    return F.try_variant_get("_record", "$", "struct<_:string>").isNull() | _misfits(F.col("_record"), kind)


def unread_records(spark: SparkSession, path: str, record: T.StructType | str) -> DataFrame:
    """What :func:`read_records` can't read, a row each: ``level`` (document or
    record) and ``text``. Blank lines are no documents and no problem."""
    documents = _documents(spark, path)
    lines = documents.where(_no_list()).select(F.lit("document").alias("level"), F.col("_text").alias("text"))
    rows = documents.select(F.explode(F.try_variant_get("_document", "$.records", "array<variant>")).alias("_record"))
    records = rows.where(_unfit_record(_record_type(record)))
    return lines.unionByName(records.select(F.lit("record").alias("level"), F.col("_record").cast("string").alias("text")))


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Several named Parquet tables of one folder."""
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in names}


def read_database(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str]) -> DataFrame:
    """Database table over JDBC, one partition per predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))


def past_mark(column: str, mark, inclusive: bool = True, by_day: bool = False) -> Column:
    """Rows from a mark on (``inclusive``) or after it, by time or by day."""
    value = as_date(F.col(column)) if by_day else F.col(column)
    limit = as_date(mark) if by_day else (F.lit(mark) if not isinstance(mark, Column) else mark)
    return value >= limit if inclusive else value > limit


def read_since(
    df: DataFrame,
    column: str,
    mark,
    inclusive: bool = True,
    by_day: bool = False,
    limit: int | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Source rows past a mark; with ``limit`` the first page of them.

    A page is cut in the order of the mark and the tie columns, which must
    make it total.
    """
    rows = df.where(past_mark(column, mark, inclusive, by_day))
    return rows if limit is None else rows.orderBy(column, *tie).limit(limit)


def read_after(df: DataFrame, order: Sequence[str], last: Sequence, limit: int) -> DataFrame:
    """The page after a row: up to ``limit`` rows that follow the values
    ``last`` in a total order. Rows with equal marks may lie on both sides."""
    follows = F.lit(False)
    for name, value in reversed(list(zip(order, last))):
        follows = (F.col(name) > value) | ((F.col(name) == value) & follows)
    # The leading column alone bounds the scan.
    return df.where(F.col(order[0]) >= last[0]).where(follows).orderBy(*order).limit(limit)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """The mark a batch leaves behind: one row, null for an empty batch."""
    return df.agg(F.max(column).alias("value"))
