"""Sources (SRC)."""

from pyspark.sql import functions as F

from lakeops.queries.registry import MONTH_SQL, Tables, by_month, query, sum_sql
from lakeops.functions.money import exact_sum
from lakeops.operators.layout import buckets_for, write_bucketed, write_table
from lakeops.session import shuffle_partitions
from lakeops.sources import derived, streams, tables
from lakeops.streaming.envelope import to_envelope
from lakeops.streaming.sinks import append_stream, drain

# A micro-batch takes at most this much of the input.
BATCH = 256 * 1024**3
EVENT_FIELDS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def write_events(t: Tables, fmt: str = "parquet", per_task: int = 1) -> str:
    """Events as a directory of several files, as a stream source wants them."""
    path = t.scratch(f"events-{fmt}")
    writer = t.events.repartition(per_task * shuffle_partitions(t.spark), "event_id").write.format(fmt)
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").save(path)
    return path


def drained(t: Tables, df, name: str, partition_by=()):
    path = t.scratch(name)
    drain(append_stream(df, path, t.scratch(name + "-ck"), partition_by))
    return t.spark.read.parquet(path)


@query("src01_parquet_scan", "SELECT * FROM orders")
def _(t):
    return tables.parquet(t.spark, t.path("orders"))


@query("src02_column_list", "SELECT o_custkey, o_totalprice FROM orders")
def _(t):
    return tables.parquet(t.spark, t.path("orders"), ["o_custkey", "o_totalprice"])


@query(
    "src03_partition_filter",
    f"SELECT o_orderkey, o_totalprice, {MONTH_SQL} AS month FROM orders WHERE {MONTH_SQL} = DATE '1997-03-01'",
)
def _(t):
    path = write_table(by_month(t.orders), t.scratch("orders-month"), partition_by=["month"])
    month = F.lit("1997-03-01").cast("date")
    return t.spark.read.parquet(path).filter(F.col("month") == month).select("o_orderkey", "o_totalprice", "month")


@query("src04_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = t.scratch("customer-csv")
    t.customer.write.option("header", True).csv(path)
    return tables.csv(t.spark, path, t.customer.schema)


@query("src05_catalog_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    path = t.scratch("orders-catalog")
    name = write_bucketed(t.orders, "src05_" + path[-32:], ["o_custkey"], buckets_for(t.orders), path)
    return tables.catalog(t.spark, name).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "src06_sql_text",
    "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderstatus",
)
def _(t):
    return tables.sql_over(
        t.spark,
        "SELECT o_orderstatus, count(*) AS n_rows FROM {o} WHERE o_orderdate >= TIMESTAMP_NTZ '1996-01-01' GROUP BY o_orderstatus",
        o=t.orders,
    )


@query(
    "src07_kafka_envelope",
    "SELECT CAST(event_id AS VARCHAR) AS k, event_type, value, CAST(ts AS TIMESTAMP) AS kafka_ts FROM events",
)
def _(t):
    """The frame a topic gives (key, value, timestamp), read from files: no broker is needed."""
    path = t.scratch("envelope")
    to_envelope(t.events, "event_id", "ts", ["event_type", "value"]).write.parquet(path)
    stream = streams.like_static(t.spark, path)
    opened = stream.select(
        F.col("key").cast("string").alias("k"),
        F.from_json(F.col("value").cast("string"), "event_type string, value double").alias("o"),
        F.col("timestamp").cast("timestamp_ntz").alias("kafka_ts"),
    ).select("k", "o.*", "kafka_ts")
    return drained(t, opened, "kafka-out")


@query("src08_parquet_stream", "SELECT * FROM events")
def _(t):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(EVENT_FIELDS)
    return drained(t, streams.files(t.spark, write_events(t), schema, bytes_per_batch=BATCH), "parquet-stream")


@query("src09_json_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(t):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(EVENT_FIELDS)
    return drained(t, streams.files(t.spark, write_events(t, "json"), schema, "json", bytes_per_batch=BATCH), "json-stream")


@query("src10_stream_like_static", "SELECT event_id, user_id, value FROM events")
def _(t):
    stream = streams.like_static(t.spark, write_events(t)).select("event_id", "user_id", "value")
    return drained(t, stream, "like-static")


@query(
    "src11_local_rows_and_range",
    "WITH s(o_orderstatus, meaning) AS (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')), "
    "r AS (SELECT unnest(range((SELECT count(*) FROM orders))) AS id) "
    "SELECT meaning, count(*) AS n_rows, CAST((SELECT sum(id) FROM r) AS BIGINT) AS id_sum "
    "FROM orders JOIN s USING (o_orderstatus) GROUP BY meaning",
)
def _(t):
    """In-line rows as a dimension of the orders, and a range as long as the table."""
    names = t.spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, meaning string")
    id_sum = t.spark.range(t.orders.count()).agg(F.sum("id").alias("s")).scalar()
    counts = t.orders.join(F.broadcast(names), "o_orderstatus").groupBy("meaning").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("id_sum", id_sum)


@query("src12_uri_path", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    """A full URI is an ordinary path; s3a:// works the same where its connector is present."""
    path = t.scratch("uri")
    uri = path if "://" in path else f"file://{path}"
    write_table(t.supplier, uri)
    return tables.parquet(t.spark, uri)


@query(
    "src13_skewed_star",
    f"""
    WITH o AS (SELECT o_orderkey * 3 + c AS id, o_custkey, o_orderstatus, o_totalprice, {MONTH_SQL} AS month FROM orders, (VALUES (0), (1), (2)) v(c)),
    f AS (SELECT * REPLACE (CASE WHEN id % 100 < 30 THEN 1 ELSE o_custkey END AS o_custkey) FROM o)
    SELECT month, o_orderstatus, c_mktsegment, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount
    FROM f JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
)
def _(t):
    """The orders three times, thirty per cent of them on one customer, summed up by month, status and segment."""
    rows = by_month(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    fact = derived.skewed(derived.enlarged(rows, "o_orderkey", 3), "o_custkey", "o_orderkey", 30, 1)
    joined = fact.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return joined.groupBy("month", "o_orderstatus", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("txns"), exact_sum("o_totalprice").alias("total_amount")
    )


@query(
    "src14_customer_profiles",
    """
    SELECT c_custkey AS customer_id, upper(substr(n_name, 1, 3)) || '-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS reference,
      lower(replace(c_name, '#', '.')) || '@' || lower(replace(n_name, ' ', '-')) || '.example' AS mailbox, n_name AS country, c_mktsegment AS segment,
      CASE WHEN c_acctbal < 0 THEN 'IN DEBT' WHEN c_acctbal < 2500 THEN 'LOW' WHEN c_acctbal < 7500 THEN 'FAIR' ELSE 'HIGH' END AS standing, c_acctbal < 0 AS owes
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def _(t):
    return derived.profiles(t.customer, t.nation)
