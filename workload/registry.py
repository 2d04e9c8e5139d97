"""Queries by name, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.inputs import present

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ints: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under a name, its result in plain types.

    ``ints`` names columns which the SQL yields as 32 bit integers.
    """

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            wide = ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in ints)
            ORACLE[name] = f"SELECT * REPLACE ({wide}) FROM ({sql})" if ints else sql
        return fn

    return register
