"""Stream sources. Each returns a streaming frame; none of them starts a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
) -> DataFrame:
    """key, value and timestamp of a topic. Needs Spark's Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("key", "value", "timestamp")


def files(
    spark: SparkSession,
    directory: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """New files of a growing directory (Parquet or JSON lines), schema declared.

    Limit a micro-batch by files or by bytes, not by both.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(directory)


def like_static(spark: SparkSession, directory: str, **limits) -> DataFrame:
    """A Parquet file stream that takes its schema from what the directory holds now."""
    return files(spark, directory, spark.read.parquet(directory).schema, "parquet", **limits)
