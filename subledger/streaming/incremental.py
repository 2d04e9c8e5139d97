"""Loads that go on where the last one ended."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.sources.readers import high_water_mark, past_mark, read_since
from subledger.sources.tables import append_table, read_table, table_exists, upsert_partitions, upsert_table

CONTROL_SCHEMA = "object string, value string"


def read_mark(spark: SparkSession, control: str, name: str, default: str) -> str:
    """Mark stored for an object, or the default before its first load."""
    if not table_exists(spark, control):
        return default
    row = read_table(spark, control).where(F.col("object") == name).select("value").head()
    return row["value"] if row else default


def write_mark(spark: SparkSession, control: str, name: str, value: str) -> None:
    upsert_table(spark.createDataFrame([(name, value)], CONTROL_SCHEMA), control, ["object"])


def incremental_load(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    control: str,
    name: str,
    mark: str,
    keys: Sequence[str],
    default: str,
    inclusive: bool = True,
    by_day: bool = False,
    mode: str = "upsert",
    partition: str | None = None,
) -> str:
    """Source rows past the stored mark into the target; returns the new mark.

    The mark is written after the load. A load that fails, or is run twice,
    reads the same rows again and the upsert makes that harmless, which is
    also why rows equal to the mark are read by default. An append leaves out
    rows whose key the target holds from the stored mark on, so it needs keys
    too. With ``partition``, one of the keys, an upsert rewrites the touched
    partitions only, which is the way for targets much larger than a batch.
    ``target`` and ``control`` are names of catalog tables.
    """
    if mode not in ("upsert", "append"):
        raise ValueError("mode must be 'upsert' or 'append'")
    if not keys:
        raise ValueError("a load that can be repeated needs keys")
    if partition is not None and mode == "append":
        raise ValueError("a partitioned target is upserted")
    last = read_mark(spark, control, name, default)
    limit = F.lit(last).cast(source.schema[mark].dataType)
    batch = read_since(source, mark, limit, inclusive, by_day)
    reached = high_water_mark(batch, mark).select(F.col("value").cast("string")).head()["value"]
    if reached is None:
        return last
    # The batch ends at the mark reached, also when rows arrive meanwhile.
    batch = batch.where(F.col(mark) <= F.lit(reached).cast(source.schema[mark].dataType))
    if mode == "append":
        if table_exists(spark, target):
            loaded = read_table(spark, target).where(past_mark(mark, limit, by_day=by_day))
            batch = batch.join(loaded.select(*keys), list(keys), "left_anti")
        append_table(batch, target)
    elif partition is not None:
        upsert_partitions(batch, target, keys, partition, order=[mark])
    else:
        upsert_table(batch, target, keys, order=[mark])
    write_mark(spark, control, name, reached)
    return reached
