"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.session import apply_profile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, tables: str, sql: str | None = None):
    """Register `fn(spark, *frames of the tables)` under a name."""

    def register(fn: Callable[[SparkSession, DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_profile(spark)
            return fn(spark, *(spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables.split()))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register
