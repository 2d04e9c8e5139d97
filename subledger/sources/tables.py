"""Catalog tables with replace, append and keyed upsert; CSV and bundles.

Tables are Spark's own: their schema, partitions and place are in the catalog,
and rows are put there by ``saveAsTable`` and ``insertInto``. As with any such
table there is one writer at a time. Names are ``database.table``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.merge import delete_keys, landing_type, upsert
from subledger.session import scratch_table
from subledger.sources.readers import CSV_OPTIONS

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Column by which tables of hashed buckets are partitioned.
BUCKET = "_bucket"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns, null where older files lack a column.

    Files are listed anew: a stream or another session may have written some.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _landing(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, landing_type(f.dataType)) for f in schema])


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types, null where ``df`` lacks one."""
    given = set(df.columns)
    return df.select(
        [(F.col(f"`{f.name}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def _create(df: DataFrame, name: str, partition: str | None = None, buckets: int | None = None, keys: Sequence[str] = ()) -> None:
    writer = _typed(df, _landing(df.schema)).write.format("parquet")
    if partition is not None:
        writer = writer.partitionBy(partition)
    if buckets is not None:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def replace_table(df: DataFrame, name: str, buckets: int | None = None, keys: Sequence[str] = ()) -> None:
    """The table's content and columns become those of ``df``, which may read the table.

    The new content is written whole as a table beside the old one before it
    takes its name, so a job that dies while writing leaves the old one as it
    was. With ``buckets`` rows are stored by a hash of ``keys``, and joins on
    them need not shuffle the table.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        return _create(df, name, buckets=buckets, keys=keys)
    fresh = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    _create(df, fresh, buckets=buckets, keys=keys)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def _widen(spark: SparkSession, name: str, batch: T.StructType) -> T.StructType:
    """The table's schema after it got the batch's new columns; no file is rewritten."""
    known = set(spark.table(name).columns)
    if new := [f for f in _landing(batch) if f.name not in known]:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    return spark.table(name).schema


def append_table(df: DataFrame, name: str) -> None:
    """Rows added; columns that the table lacks are added, nothing is rewritten."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        return _create(df, name)
    _typed(df, _widen(spark, name, df.schema)).write.insertInto(name)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each write go as soon as it ends. Otherwise they stay until
    the driver happens to collect its garbage, those of a whole chain of writes."""
    before = spark.conf.get(_FREE)
    spark.conf.set(_FREE, True)
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The batch as a table of its own, however often the load looks at it; so it
    is computed once, which a stream with state relies on, and needs no executor
    to stay alive. The table goes when the load is done."""
    spark = df.sparkSession
    name = scratch_table(spark, "staged")
    _create(df, name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def upsert_table(updates: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None, **how) -> None:
    """Keyed upsert into a table, which is created by its first batch.

    Takes the options of :func:`subledger.operators.merge.upsert`. An empty
    batch writes nothing. The whole table is written anew, with ``buckets`` by
    a hash of the key, so that its rows needn't move to meet the next batch;
    for a table much larger than its batches see :func:`upsert_partitions` and
    :func:`upsert_bucketed`.
    """
    spark = updates.sparkSession
    with staged(updates) as batch:
        if batch.isEmpty():
            return
        target = read_table(spark, name) if table_exists(spark, name) else spark.createDataFrame([], batch.schema)
        replace_table(upsert(target, batch, keys, **how), name, buckets, keys)


def delete_from_table(doomed: DataFrame, name: str, keys: Sequence[str]) -> None:
    spark = doomed.sparkSession
    replace_table(delete_keys(read_table(spark, name), doomed, keys), name)


def in_partitions(spark: SparkSession, name: str, partition: str, values: Sequence) -> DataFrame:
    """The table's rows in these partitions; the catalog lists no others."""
    return spark.table(name).where(F.col(partition).isin(list(values)))


def overwrite_partitions(df: DataFrame, name: str, partition: str, gather: bool = True) -> None:
    """The partitions that ``df`` has rows of become these rows; others aren't touched.

    ``df`` may read the table: partitions are replaced once all is written. The
    rebalance gathers a partition's rows for few files, and splits a partition
    that holds far more than the others between tasks. Without ``gather`` each
    task writes what it has, which spares a shuffle of a single large partition.
    """
    spark = df.sparkSession
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        rows = _typed(df, spark.table(name).schema)
        (rows.hint("rebalance", partition) if gather else rows).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, before)


def upsert_partitions(updates: DataFrame, name: str, keys: Sequence[str], partition: str, **how) -> None:
    """Keyed upsert into a table partitioned by one column of the key.

    Partitions without an update are not listed, read or written, so the cost
    is that of the dates in the batch and not of the table. A null partition
    value is refused.
    """
    with staged(updates) as batch:
        upsert_staged(batch, name, keys, partition, **how)


def upsert_staged(batch: DataFrame, name: str, keys: Sequence[str], partition: str, gather: bool = True, **how) -> None:
    """:func:`upsert_partitions` of a batch that is stored already, which is not written again."""
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    # As many values as directories the write commits.
    touched = [r[0] for r in batch.select(partition).distinct().collect()]
    if None in touched:
        raise ValueError(f"null in {partition}, by which the table is partitioned")
    # Spark leaves out all that would meet a target known to be empty.
    nothing = batch.where(F.lit(False))
    if not table_exists(spark, name):
        merged = upsert(nothing, batch, keys, **how)
        return _create(merged.hint("rebalance", partition) if gather else merged, name, partition)
    _widen(spark, name, batch.schema)
    target = in_partitions(spark, name, partition, touched)
    overwrite_partitions(upsert(nothing if target.isEmpty() else target, batch, keys, **how), name, partition, gather)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_bucketed(updates: DataFrame, name: str, keys: Sequence[str], buckets: int, **how) -> None:
    """Keyed upsert into a table of any key, partitioned by a hash of it.

    Only buckets that hold a key of the batch are listed, read and written, so
    a batch of few keys costs a few buckets and not the table. ``buckets`` must
    stay the same for the table's life; 128 MB of rows a bucket is a good size.
    Takes the options of :func:`subledger.operators.merge.upsert`; the table
    has the column ``_bucket`` besides its own.
    """
    if how.get("update_cols") is not None:
        how = how | {"update_cols": [c for c in how["update_cols"] if c != BUCKET]}
    upsert_partitions(updates.withColumn(BUCKET, bucket_of(keys, buckets)), name, [*keys, BUCKET], BUCKET, **how)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that :func:`subledger.sources.readers.read_export` reads back as it
    was: line breaks, quotes, outer spaces, empty texts and nulls included."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**CSV_OPTIONS, **kept, quoteAll=True).csv(path)


def write_report_bundle(
    extract: DataFrame,
    sheets: Callable[[DataFrame], Mapping[str, DataFrame]],
    path: str,
    write: Callable[[DataFrame, str], None] = write_csv,
) -> None:
    """An extract and the results made from it, each in its own folder below
    ``path``. The extract is computed once: the results read what was stored."""
    root = path.rstrip("/")
    extract.write.mode("overwrite").parquet(f"{root}/_extract")
    for name, sheet in sheets(extract.sparkSession.read.parquet(f"{root}/_extract")).items():
        write(sheet, f"{root}/{name}")
