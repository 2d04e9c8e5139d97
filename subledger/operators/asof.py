"""Joins of each row with what was newest at its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.session import scratch_path


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
) -> DataFrame:
    """All rows with the ``columns`` of the newest version of their key whose
    ``since`` isn't after the row's ``at``; null if there is none.

    Of versions of one time the last in ``tie`` counts. Rows and versions of
    null keys, and those without a time, meet nothing; such rows are kept.

    Rows and versions are dealt together by ranges of key and time, so a key
    with very many of either is shared by many tasks. Within a task's range the
    last version is carried along, and into the range comes the last version
    of the ranges before, of which there is at most one a range and key.
    """
    keys, tie = list(keys), list(tie)
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    version = F.struct(F.col(since).alias("_since"), *(F.col(c).alias(f"_t{i}") for i, c in enumerate(tie)), *columns)
    older = versions.where(f"{known} AND `{since}` IS NOT NULL").select(
        *keys, F.col(since).alias("_time"), F.lit(0).alias("_kind"), version.alias("_version"), F.lit(None).cast(rows.schema).alias("_row")
    )
    kind = older.schema["_version"].dataType
    newer = rows.where(f"{known} AND `{at}` IS NOT NULL").select(
        *keys, F.col(at).alias("_time"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_version"), F.struct("*").alias("_row")
    )
    united = older.unionByName(newer)
    # Equal rows are told apart for the ranges alone.
    dealt = united.withColumn("_dealt", F.monotonically_increasing_id()).repartitionByRange(*keys, "_time", "_kind", "_dealt")
    path = scratch_path(rows.sparkSession, "asof")
    dealt.drop("_dealt").withColumn("_part", F.spark_partition_id()).write.parquet(path)
    stored = rows.sparkSession.read.schema(dealt.drop("_dealt").withColumn("_part", F.spark_partition_id()).schema).parquet(path)

    last = stored.where("_kind = 0").groupBy(*keys, "_part").agg(F.max("_version").alias("_version"))
    parts = stored.select(*keys, "_part").distinct().join(last, [*keys, "_part"], "left")
    by_part = Window.partitionBy(*keys).orderBy("_part")
    before = F.last("_version", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    # Only a key that spans ranges has one before: at most one a border.
    carried = parts.select(*keys, "_part", before.alias("_before")).where("_before IS NOT NULL")
    within = Window.partitionBy(*keys, "_part").orderBy("_time", "_kind", "_version")
    here = F.last("_version", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = stored.withColumn("_here", here).where("_kind = 1").join(F.broadcast(carried), [*keys, "_part"], "left")
    newest = F.coalesce("_here", "_before")
    met = found.select("_row.*", *(newest[c].alias(c) for c in columns))
    alone = rows.where(f"NOT ({known} AND `{at}` IS NOT NULL)")
    return met.unionByName(alone, allowMissingColumns=True)
