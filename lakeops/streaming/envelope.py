"""Kafka-style envelope (key, value, timestamp) to typed columns; works on batch and stream frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.dates import parse_event_ts

CORRUPT = "_corrupt"


def parse_envelope(
    df: DataFrame,
    schema: StructType,
    event_ts: str = "event_ts",
    ingest_ts: Column | None = None,
    pattern: str | None = None,
    keep_corrupt: bool = True,
) -> DataFrame:
    """Columns of the JSON value plus k, kafka_ts, ingest_ts and dt.

    Malformed JSON, wrong types and bad times give nulls and the raw text in `_corrupt`
    instead of failing the query. Give `ingest_ts` to make a replay repeatable; it is the
    time of the batch otherwise.
    """
    declared = StructType(
        [StructField(f.name, StringType() if f.name == event_ts else f.dataType) for f in schema]
        + [StructField(CORRUPT, StringType())]
    )
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    opened = df.select(
        F.from_json(text, declared, options).alias("o"),
        text.alias("__text"),
        F.col("key").cast("string").alias("k"),
        F.col("timestamp").alias("kafka_ts"),
        (ingest_ts if ingest_ts is not None else F.current_timestamp()).alias("ingest_ts"),
    )
    parsed = opened.select("o.*", "__text", "k", "kafka_ts", "ingest_ts")
    when = parse_event_ts(event_ts, pattern)
    bad_time = F.col(event_ts).isNotNull() & when.isNull()
    corrupt = F.when(F.col(CORRUPT).isNotNull() | bad_time, F.col("__text"))
    out = parsed.withColumns({CORRUPT: corrupt, event_ts: when}).drop("__text").withColumn("dt", F.to_date(event_ts))
    return out if keep_corrupt else out.drop(CORRUPT)


def to_envelope(df: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """The reverse: rows as the binary envelope a topic would carry."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*columns)).cast("binary").alias("value"),
        F.col(ts).cast("timestamp").alias("timestamp"),
    )


def clean(df: DataFrame, event_ts: str, required: list[str], ingest_ts: Column | None = None) -> DataFrame:
    """Stateless cleaning: event time parsed, ingest time stamped, rows without the required columns dropped."""
    return (
        df.withColumn(event_ts, parse_event_ts(F.col(event_ts).cast("string")))
        .withColumn("ingest_ts", ingest_ts if ingest_ts is not None else F.current_timestamp())
        .na.drop(subset=[event_ts, *required])
        .withColumn("dt", F.to_date(event_ts))
    )
