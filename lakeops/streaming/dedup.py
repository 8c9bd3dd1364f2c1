"""Watermarked deduplication. A watermark is set only where state uses it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _zoned(df: DataFrame, event_ts: str) -> DataFrame:
    """A watermark needs a zoned timestamp."""
    return df.withColumn(event_ts, F.col(event_ts).cast("timestamp"))


def first_per_key(
    df: DataFrame, keys: list[str], event_ts: str, delay: str = "3 days", spread: Column | None = None
) -> DataFrame:
    """The first arrival per key; later copies within the delay are dropped, and state ends with it.

    Streaming state has no map-side combine: all copies of a key meet in one task. Where
    one key may have very many copies, give `spread`, a small integer that differs between
    copies (a hash of the broker offset, say). Copies are then dropped per (key, spread)
    first, and at most one copy per spread value meets in the second step.
    """
    rows = _zoned(df, event_ts).withWatermark(event_ts, delay)
    if spread is not None:
        rows = rows.withColumn("__spread", spread).dropDuplicatesWithinWatermark([*keys, "__spread"]).drop("__spread")
    return rows.dropDuplicatesWithinWatermark(keys)


def distinct_events(df: DataFrame, keys: list[str], event_ts: str, delay: str = "3 days") -> DataFrame:
    """One row per (keys, event time): exact re-sends go, later corrections of a key stay."""
    return _zoned(df, event_ts).withWatermark(event_ts, delay).dropDuplicates([*keys, event_ts])
