"""The newest version per key as a stream with state of its own."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from subledger.sources.tables import upsert_bucketed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestVersion(StatefulProcessor):
    """Holds one version per key and passes on a version that is newer than it."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], state: T.StructType):
        self.columns, self.state = list(columns), state
        self.places = [self.columns.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        def rank(row: tuple) -> tuple:
            # A missing value is older than any other.
            return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in self.places)

        before = tuple(self.newest.get()) if self.newest.exists() else None
        best = before
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            if best is None or rank(values) >= rank(best):
                best = values
        if best != before:
            self.newest.update(best)
            yield Row(**dict(zip(self.columns, best, strict=True)))

    def close(self) -> None:
        pass


def newest_versions(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of a stream in any order, each version that is newer than what came before of its key.

    State is one row per key, in RocksDB: each executor works on a local copy
    that Spark saves to the checkpoint, so neither a lost executor nor a
    restart loses it, and it need not fit into memory. Of versions that
    ``order`` doesn't tell apart the later one counts. A null key is a key.
    """
    kinds = {f.name: f.dataType for f in stream.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    # The state hands times back in another zone than rows have them in: whole microseconds have none.
    plain = stream.withColumns({n: F.unix_micros(F.col(n).cast("timestamp")) for n in kinds})
    processor = NewestVersion(plain.columns, order, plain.schema)
    found = plain.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=plain.schema, outputMode="Update", timeMode="None"
    )
    return found.withColumns({n: F.timestamp_micros(n).cast(kind) for n, kind in kinds.items()})


def run_newest_stream(
    stream: DataFrame, name: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64
) -> None:
    """Everything available now into a catalog table of the newest versions, then stop.

    Versions that are older than what was loaded are dropped by the state and
    reach no table, so a table needn't be read to find them; a micro-batch that
    is repeated puts the same rows there again.
    """
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.streaming.stateStore.providerClass")
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        query = (
            newest_versions(stream, keys, order)
            .writeStream.foreachBatch(lambda batch, _: upsert_bucketed(batch, name, keys, buckets, order=order))
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        conf.set("spark.sql.streaming.stateStore.providerClass", before)
