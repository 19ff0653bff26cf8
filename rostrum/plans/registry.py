"""Named queries and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query by its function's name, with its SQL if it has one."""

    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def rows(spark: SparkSession, folder: str, name: str, *columns: str, where: str | None = None) -> DataFrame:
    """Columns of a table as SQL expressions, which the queries' SQL shares."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.where(where) if where else df
    return df.selectExpr(*columns) if columns else df


from rostrum.plans import audit, linkage, matching, ordered, proceedings, relational, streams, text  # noqa: E402, F401
