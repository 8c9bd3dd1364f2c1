"""Batch scans. Paths are parameters: any URI Spark's file systems know will do."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV with a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).option("header", header).csv(path)


def catalog(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, which keeps its bucketing."""
    return spark.table(name)


def sql_over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over frames, referred to as {name}."""
    return spark.sql(text, **frames)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def on_day(
    df: DataFrame, day: date, part_col: str = "dt", ts_col: str | None = None, period: str = "day"
) -> DataFrame:
    """Rows of one day, keeping partition pruning.

    With `ts_col` the day is meant on the timestamp; the predicate on the partition
    column that follows from it is added, since Spark cannot know the link between them.
    `period` says what a partition holds: a day, or the month or year that begins on
    the partition column's date.
    """
    start = {"day": day, "month": day.replace(day=1), "year": day.replace(month=1, day=1)}[period]
    if start != day and not ts_col:
        raise ValueError("a day within a longer partition needs the timestamp column")
    keep: Column = F.col(part_col) == F.lit(start)
    if ts_col:
        keep = keep & (F.to_date(ts_col) == F.lit(day))
    return df.filter(keep)


def day_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Half-open range on a raw column, so that it reaches the scan as a pushed filter."""
    kind = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))
