"""The incremental load as a Structured Streaming job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from subledger.sources.tables import upsert_partitions, upsert_table


def stream_parquet(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, new files as they land."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_upsert_stream(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    partition: str | None = None,
) -> None:
    """Everything available now into a catalog table, then stop.

    A micro-batch that is repeated after a failure writes the same rows again,
    and so do repeated rows: the key decides, and no row is too late. Within a
    batch the last in ``order`` counts, among batches the later one. With
    ``partition`` only the touched partitions are rewritten.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        if partition is None:
            upsert_table(batch, name, keys, order=order)
        else:
            upsert_partitions(batch, name, keys, partition, order=order)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
