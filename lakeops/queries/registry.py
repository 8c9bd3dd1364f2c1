"""Registration, and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import apply_profile, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """`t.orders` reads a table; `t.scratch(name)` gives a fresh path in the shared folder."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def query(name: str, sql: str | None = None):
    """Register `fn(t: Tables) -> DataFrame` under a name, with its SQL if it has one."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Tables(apply_profile(spark), directory))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


# SQL for the shared derivations below.
MONTH_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE)"
HOT_SQL = "CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE o_custkey END"


def units_sql(x: str, scale: int = 2) -> str:
    return f"CAST(floor({x} * {10**scale}.0 + 0.5) AS BIGINT)"


def sum_sql(x: str, scale: int = 2) -> str:
    return f"(CAST(sum({units_sql(x, scale)}) AS DOUBLE) / CAST({10**scale} AS DOUBLE))"


def avg_sql(x: str, scale: int = 2) -> str:
    return f"(CAST(sum({units_sql(x, scale)}) AS DOUBLE) / (CAST(count({x}) AS DOUBLE) * CAST({10**scale} AS DOUBLE)))"


def thousandths(amount: str, more: str):
    """An amount with a third digit behind the point: cents and a whole number of thousandths."""
    return (F.floor(F.col(amount) * 100.0 + 0.5) * 10 + F.col(more) % 10).cast("double") / 1000.0


def thousandths_sql(amount: str, more: str) -> str:
    return f"(CAST(CAST(floor({amount} * 100.0 + 0.5) AS BIGINT) * 10 + {more} % 10 AS DOUBLE) / 1000.0)"


def decimal_sum_sql(x: str) -> str:
    """The sum in plain decimals, which knows nothing of doubles' bits."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38, 6))) AS DOUBLE)"


def by_month(orders: DataFrame) -> DataFrame:
    """Orders with the first day of their month, the partition key of the layout queries."""
    return orders.withColumn("month", F.trunc("o_orderdate", "month"))


def hot_orders(t: Tables) -> DataFrame:
    """A quarter of all orders on customer 1."""
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")).alias("custkey"),
        "o_totalprice",
        "o_orderdate",
        "o_orderstatus",
    )
