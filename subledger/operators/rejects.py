"""Loads that put aside the rows they can't take."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.sources.tables import append_table, read_table, staged, table_exists, upsert_table

REASONS = "_reasons"


def checked(
    df: DataFrame,
    schema: T.StructType | str,
    rules: Mapping[str, Column] | None = None,
    key: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows as they came, ``_row``; as the target wants them, ``_typed``; and why not, ``_reasons``.

    A row is rejected for a value that isn't of its column's type, for a null
    in a column that the schema says has none or in the key, for a rule that
    isn't true (a column expression over the typed columns; unknown passes, as
    in SQL), and for a key that an earlier row of the batch has. Everything is
    one projection, and one window over the key for the last; a key is earlier
    by ``order``, and equal rows by their content.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    given = {f.name: f.dataType for f in df.schema.fields}
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"),
        *(
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ),
    )
    found = [
        F.when(F.col("_row")[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        for f in wanted
        if f.name in given
    ]
    for f in wanted:
        if not f.nullable or f.name in key:
            source = F.col("_row")[f.name].isNull() if f.name in given else F.lit(True)
            found.append(F.when(source, F.lit(f"{f.name} is null")))
    for name, rule in (rules or {}).items():
        found.append(F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)))
    reasons = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    judged = rows.select("_row", F.struct(*(F.col(f"`{f.name}`") for f in wanted)).alias("_typed"), reasons.alias(REASONS))
    if not key:
        return judged
    # Rows rejected for another reason don't stand in the way of good ones.
    good = F.size(REASONS) == 0
    by_key = Window.partitionBy(good, *(F.col("_typed")[k] for k in key))
    first = F.row_number().over(by_key.orderBy(*(F.col("_typed")[o] for o in order), F.to_json("_row")))
    doubled = F.when(good & (F.col("_n") > 1), F.array(F.lit(f"{', '.join(key)} occurs before"))).otherwise(F.col(REASONS))
    passed = judged.where(good).withColumn("_n", first).withColumn(REASONS, doubled).drop("_n")
    return passed.unionByName(judged.where(~good))


def load_with_rejects(
    batch: DataFrame,
    name: str,
    rejects: str,
    schema: T.StructType | str,
    batch_id: str,
    rules: Mapping[str, Column] | None = None,
    key: Sequence[str] = (),
    order: Sequence[str] = (),
) -> None:
    """Good rows into the table ``name``, the others into ``rejects`` with their reasons.

    With a key good rows are upserted, else appended. A rejected row is kept as
    JSON of what came, under the batch's id. A batch that is repeated upserts
    the same rows and adds no reject again: what the table of rejects holds of
    a batch stays.
    """
    spark = batch.sparkSession
    with staged(checked(batch, schema, rules, key, order)) as judged:
        good = judged.where(F.size(REASONS) == 0).select("_typed.*")
        if key:
            upsert_table(good, name, list(key))
        elif not good.isEmpty():
            append_table(good, name)
        bad = judged.where(F.size(REASONS) > 0).select(
            F.lit(batch_id).alias("batch_id"), F.to_json("_row").alias("row"), F.col(REASONS).alias("reasons")
        )
        known = table_exists(spark, rejects) and not read_table(spark, rejects).where(F.col("batch_id") == batch_id).isEmpty()
        if not known and not bad.isEmpty():
            append_table(bad, rejects)
