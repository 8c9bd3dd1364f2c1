"""Larger, skewed and wider frames made from given tables: pure functions of their rows, so a
task that runs again makes the same ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.conditional import banded

#: What an account's balance says, by upper bound.
STANDINGS = [(0, "IN DEBT"), (2500, "LOW"), (7500, "FAIR")]


def enlarged(df: DataFrame, row_id: str, times: int) -> DataFrame:
    """Every row `times` times, under consecutive new ids. Copies are made in place, without a shuffle."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    return df.withColumn("__copy", copy).withColumn(row_id, F.col(row_id) * times + F.col("__copy")).drop("__copy")


def skewed(df: DataFrame, key: str, row_id: str, percent: int, hot) -> DataFrame:
    """The frame with `percent` of a hundred consecutive ids on the key `hot`."""
    return df.withColumn(key, F.when(F.col(row_id) % 100 < percent, F.lit(hot)).otherwise(F.col(key)))


def profiles(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """A wide customer profile: reference, mailbox, country, segment and standing of the account."""
    known = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")  # a fixed list of countries
    host = F.concat(F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))), F.lit(".example"))
    return known.select(
        F.col("c_custkey").alias("customer_id"),
        F.format_string("%s-%08d", F.upper(F.substring("n_name", 1, 3)), "c_custkey").alias("reference"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), host).alias("mailbox"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        banded("c_acctbal", STANDINGS, "HIGH").alias("standing"),
        (F.col("c_acctbal") < 0).alias("owes"),
    )
