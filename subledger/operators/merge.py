"""Keyed merges as DataFrame operations.

The side that probes is the target, so a small batch is broadcast by Spark
and the target is not shuffled; a large batch falls back to a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.keys import dedupe


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    update_cols: Sequence[str] | None = None,
    mode: str = "update",
) -> DataFrame:
    """Target after ``INSERT … ON CONFLICT (keys)`` of the updates.

    ``mode='update'`` overwrites the columns that the updates have in a row
    already there, or only ``update_cols``; ``mode='ignore'`` leaves such a row
    alone. Of several updates with one key the last in ``order`` counts. New
    columns of the updates extend the target; columns that they lack keep
    their values, and are null in inserted rows. An inserted row has all the
    columns of the updates, also those outside ``update_cols``. A null in a key
    is an error, as it would be a new row each time.
    """
    if mode not in ("update", "ignore"):
        raise ValueError("mode must be 'update' or 'ignore'")
    keys = list(keys)
    batch = dedupe(known_keys(updates, keys), keys, order, keep="last")
    if mode == "ignore":
        return _concat(target, _absent(batch, target, keys))
    if update_cols is None and not set(target.columns) <= set(batch.columns):
        update_cols = [c for c in batch.columns if c not in keys]
    if update_cols is None:
        # An anti join needs no key once only, so the keys needn't be ranked for it.
        return _concat(target.join(known_keys(updates, keys).select(keys), keys, "left_anti"), batch)
    target = evolve_schema(target, batch)
    taken = list(update_cols)
    incoming = batch.select(*keys, F.struct(*taken).alias("_in"))
    changed = target.join(incoming, keys, "left").select(
        [
            F.when(F.col("_in").isNotNull(), F.col(f"_in.{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
            for c in target.columns
        ]
    )
    return _concat(changed, _absent(batch, target, keys))


def known_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch, which raises when it is read if a key is null."""
    wrong = F.raise_error(F.lit(f"null in the key {', '.join(keys)}"))

    def kept(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.when(value.isNull(), wrong.cast(batch.schema[name].dataType)).otherwise(value)

    return batch.withColumns({k: kept(k) for k in keys})


def _absent(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks.

    The target is first cut down to keys of the batch, so that only those
    take part in the anti join.
    """
    present = target.select(keys).join(batch.select(keys), keys, "left_semi").distinct()
    return batch.join(present, keys, "left_anti")


def _concat(target: DataFrame, rows: DataFrame) -> DataFrame:
    return evolve_schema(target, rows).unionByName(rows, allowMissingColumns=True)


def evolve_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target widened by the batch's new columns, null for existing rows."""
    new = [f for f in batch.schema.fields if f.name not in target.columns]
    if not new:
        return target
    return target.withColumns({f.name: F.lit(None).cast(landing_type(f.dataType)) for f in new})


def landing_type(kind: T.DataType) -> T.DataType:
    """Type of a new column: its own, or text when the batch has only nulls."""
    return T.StringType() if isinstance(kind, T.NullType) else kind


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return _concat(target, rows)


def delete_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows whose key is among the doomed."""
    return target.join(doomed.select(*keys).distinct(), list(keys), "left_anti")
