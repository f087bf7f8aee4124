"""Registers queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..deploy import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
