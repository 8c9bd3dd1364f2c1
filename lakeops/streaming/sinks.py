"""Starting and draining streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def trigger_args(trigger: str) -> dict:
    """ "available_now", "default", or a processing interval such as "5 seconds"."""
    if trigger == "available_now":
        return {"availableNow": True}
    return {} if trigger == "default" else {"processingTime": trigger}


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: str = "available_now",
    name: str | None = None,
) -> StreamingQuery:
    """Parquet append sink; with its checkpoint every row is written once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    args = trigger_args(trigger)
    return (writer.trigger(**args) if args else writer).start(path)


def batch_stream(
    df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, trigger: str = "available_now"
) -> StreamingQuery:
    """Hand each micro-batch to `fn(batch, batch_id)`. A batch may come again after a crash."""
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    args = trigger_args(trigger)
    return (writer.trigger(**args) if args else writer).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query to end; its failure is raised here."""
    query.awaitTermination()
    return query
