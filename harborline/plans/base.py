"""The registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to as many tasks as a shuffle has: for much work on each row of a file of few bytes, which one task would read."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
