"""Declared schemas: events on the wire and the governance tables."""

from pyspark.sql import types as T

ORDER_EVENT = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("event_ts", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("op", T.StringType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One schema for batch and stream runs; batch runs leave batch_id null.
JOB_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("job_name", T.StringType(), False),
        T.StructField("batch_id", T.LongType()),
        T.StructField("git_commit", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("target_path", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("dq_failed_rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

SCHEMA_REGISTRY = T.StructType(
    [
        T.StructField("dataset_name", T.StringType()),
        T.StructField("dataset_path", T.StringType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("schema_hash", T.StringType()),
        T.StructField("snap_at", T.TimestampType()),
    ]
)
