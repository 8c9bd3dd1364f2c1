"""Sinks and physical layout (SNK)."""

from datetime import date

from pyspark.sql import functions as F

from lakeops.functions.money import exact_sum
from lakeops.operators import layout
from lakeops.operators.compaction import compact_small, files_of
from lakeops.queries.registry import MONTH_SQL, Tables, by_month, query, sum_sql
from lakeops.queries.scans import BATCH, drained, write_events
from lakeops.session import shuffle_partitions
from lakeops.sources import streams
from lakeops.streaming.sinks import batch_stream, drain

ROWS_PER_FILE = 5_000_000
FILE_ROWS = 50_000_000
MONTHLY = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, {MONTH_SQL} AS month FROM orders"
COUNTS = f"SELECT {MONTH_SQL} AS month, count(*) AS n_rows, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY 1"


def monthly_table(t: Tables, name: str = "monthly") -> str:
    return layout.write_table(by_month(t.orders), t.scratch(name), partition_by=["month"])


def month_totals(df):
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), exact_sum("o_totalprice").alias("total"))


@query("snk01_overwrite", "SELECT * FROM customer")
def _(t):
    path = t.scratch("overwrite")
    layout.write_table(t.customer.select("c_custkey"), path)
    layout.write_table(t.customer, path)
    return t.spark.read.parquet(path)


@query(
    "snk02_append",
    f"SELECT {MONTH_SQL} AS month, 2 * count(*) AS n_rows FROM orders GROUP BY 1",
)
def _(t):
    path = t.scratch("append")
    for _ in range(2):
        layout.append_table(by_month(t.orders), path, ["month"])
    return t.spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "snk03_catalog_append",
    "SELECT s_nationkey, 2 * count(*) AS n_rows FROM supplier GROUP BY s_nationkey",
)
def _(t):
    path = t.scratch("catalog-append")
    table = "snk03_" + path[-32:]
    for _ in range(2):
        layout.catalog_append(t.supplier, table, path)
    return t.spark.table(table).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_rows"))


@query("snk04_partitioned_write", MONTHLY)
def _(t):
    return t.spark.read.parquet(monthly_table(t))


@query(
    "snk05_two_level_partitions",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows FROM orders GROUP BY ALL",
)
def _(t):
    keys = ["o_orderstatus", "o_orderpriority"]
    path = layout.write_table(t.orders, t.scratch("two-level"), partition_by=keys)
    return t.spark.read.parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "snk06_rows_gathered_by_partition",
    f"SELECT {MONTH_SQL} AS month, count(*) AS n_rows, true AS as_few_as_asked FROM orders GROUP BY 1",
)
def _(t):
    """File count under control: a month of n rows has at most ceil(n / 5 million) files."""
    path = layout.write_table(by_month(t.orders), t.scratch("gathered"), partition_by=["month"], rows_per_file=ROWS_PER_FILE)
    audit = layout.file_audit(t.spark.read.parquet(path), ["month"])
    few = F.col("n_files") <= F.ceil(F.col("n_rows") / ROWS_PER_FILE)
    return audit.select("month", "n_rows", few.alias("as_few_as_asked"))


@query(
    "snk07_one_file_per_partition",
    f"SELECT {MONTH_SQL} AS month, count(*) AS n_rows, true AS as_few_as_possible FROM orders GROUP BY 1",
)
def _(t):
    """One file per month, or as many as hold its rows at a file's worth each, every file by its own task."""
    path = layout.write_table(by_month(t.orders), t.scratch("single"), partition_by=["month"], rows_per_file=FILE_ROWS)
    audit = layout.file_audit(t.spark.read.parquet(path), ["month"])
    few = F.col("n_files") <= F.ceil(F.col("n_rows") / FILE_ROWS)
    return audit.select("month", "n_rows", few.alias("as_few_as_possible"))


@query(
    "snk08_layout_audit",
    f"SELECT {MONTH_SQL} AS month, count(*) AS n_rows, true AS fewer_files FROM orders GROUP BY 1",
)
def _(t):
    """The same table written from scattered and from gathered rows: rows equal, files fewer."""
    rows = by_month(t.orders)
    scattered = layout.write_table(rows.repartition(8), t.scratch("scattered"), partition_by=["month"], gather=False)
    gathered = layout.write_table(rows, t.scratch("gathered"), partition_by=["month"])
    a = layout.file_audit(t.spark.read.parquet(scattered), ["month"]).withColumnRenamed("n_files", "scattered_files")
    b = layout.file_audit(t.spark.read.parquet(gathered), ["month"]).select("month", F.col("n_files").alias("gathered_files"))
    fewer = F.col("gathered_files") <= F.col("scattered_files")
    return a.join(b, "month").select("month", "n_rows", fewer.alias("fewer_files"))


@query(
    "snk09_compaction",
    "SELECT count(*) AS n_rows, true AS as_planned FROM events",
)
def _(t):
    """Many small files packed by target size; rows stay, files come near the planned number."""
    small = write_events(t, per_task=2)
    target = t.scratch("compacted")
    size = layout.table_bytes(t.spark.read.parquet(small))
    planned = layout.compact(t.spark, small, target, target_bytes=max(1, size // 3))
    audit = layout.file_audit(t.spark.read.parquet(target), [])
    return audit.select("n_rows", (F.col("n_files") <= 2 * planned).alias("as_planned"))


@query(
    "snk09_selective_compaction",
    f"SELECT month, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files, month < DATE '1996-01-01' OR count(DISTINCT odd) = 1 AS same_file FROM (SELECT {MONTH_SQL} AS month, o_orderkey % 2 AS odd FROM orders) GROUP BY month",
)
def _(t):
    """Months before 1996 in one file each, later ones in two, by odd and even keys: these are written together, the others stay as they are."""
    rows, path = by_month(t.orders), t.scratch("selective")
    old = F.col("month") < F.lit("1996-01-01").cast("date")
    rows.filter(old).repartition("month").write.partitionBy("month").parquet(path)
    for odd in (0, 1):
        rows.filter(~old & (F.col("o_orderkey") % 2 == odd)).repartition("month").write.mode("append").partitionBy("month").parquet(path)
    before = files_of(t.spark, path).select("file").checkpoint()
    compact_small(t.spark, path)
    folder = F.to_date(F.regexp_extract("folder", "month=([0-9-]+)", 1)).alias("month")
    after = files_of(t.spark, path).join(before.withColumn("__was", F.lit(True)), "file", "left")
    per_month = after.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.bool_and(F.col("__was").isNotNull()).alias("same_file"))
    return t.spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows")).join(per_month, "month")


@query(
    "snk10_dynamic_overwrite",
    f"""SELECT o_orderkey, {MONTH_SQL} AS month,
        CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderstatus || '*' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def _(t):
    """New values for the months from 1999 on; the other partitions keep theirs. The data comes from the table itself."""
    path = monthly_table(t, "dynamic")
    changed = t.spark.read.parquet(path).filter(F.col("month") >= F.lit("1999-01-01").cast("date"))
    layout.overwrite_partitions(changed.withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("*"))), path, ["month"])
    return t.spark.read.parquet(path).select("o_orderkey", "month", "o_orderstatus")


@query(
    "snk11_publish_day",
    f"""SELECT {MONTH_SQL} AS month, count(*) AS n_rows, {sum_sql('o_totalprice')} AS total
        FROM orders WHERE {MONTH_SQL} IN (DATE '1996-05-01', DATE '1996-06-01') GROUP BY 1""",
)
def _(t):
    path = t.scratch("publish")
    for day in (date(1996, 5, 1), date(1996, 6, 1), date(1996, 5, 1)):
        layout.publish_day(by_month(t.orders), path, "month", day)
    return month_totals(t.spark.read.parquet(path))


@query("snk12_load_all_days", COUNTS)
def _(t):
    """All periods in one partitioned write, twice: a rerun adds nothing."""
    path = t.scratch("all-days")
    for _ in range(2):
        layout.overwrite_partitions(by_month(t.orders), path, ["month"])
    return month_totals(t.spark.read.parquet(path))


@query("snk13_bucketed_table", f"SELECT o_custkey, count(*) AS n_rows, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY o_custkey")
def _(t):
    path = t.scratch("bucketed")
    table = layout.write_bucketed(t.orders, "snk13_" + path[-32:], ["o_custkey"], layout.buckets_for(t.orders), path)
    return t.spark.table(table).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_rows"), exact_sum("o_totalprice").alias("total")
    )


@query(
    "snk14_update_delete",
    f"""SELECT o_orderkey, {MONTH_SQL} AS month, CASE WHEN o_orderpriority = '1-URGENT' THEN floor(o_totalprice * 110.0 + 0.5) / 100.0 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1995-04-01' OR o_orderstatus = 'P')""",
)
def _(t):
    """Update by priority, then delete one status and the whole first quarter of 1995."""
    path, part = monthly_table(t, "update-delete"), ["month"]
    raised = F.floor(F.col("o_totalprice") * 110.0 + 0.5) / 100.0
    layout.update_where(t.spark, path, part, F.col("o_orderpriority") == "1-URGENT", {"o_totalprice": raised})
    early = F.col("o_orderdate") < F.lit("1995-04-01").cast("timestamp_ntz")
    layout.delete_where(t.spark, path, part, early | (F.col("o_orderstatus") == "P"))
    return t.spark.read.parquet(path).select("o_orderkey", "month", "o_totalprice")


@query("snk14_delete_blank_partition", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_orderkey % 7 <> 0")
def _(t):
    """All rows of a partition whose name holds a blank, and some of the others."""
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    path = layout.write_table(rows, t.scratch("priorities"), partition_by=["o_orderpriority"])
    gone = (F.col("o_orderpriority") == "4-NOT SPECIFIED") | (F.col("o_orderkey") % 7 == 0)
    layout.delete_where(t.spark, path, ["o_orderpriority"], gone)
    return layout.read_if_any(t.spark, path, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("snk15_stream_append_sink", "SELECT event_id, user_id, value, event_type FROM events")
def _(t):
    stream = streams.like_static(t.spark, write_events(t), bytes_per_batch=BATCH).select("event_id", "user_id", "value", "event_type")
    return drained(t, stream, "append-sink", ["event_type"]).select("event_id", "user_id", "value", "event_type")


@query(
    "snk16_foreach_batch_sink",
    "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type",
)
def _(t):
    """Each batch replaces its own folder, so a batch that comes twice counts once."""
    out = t.scratch("foreach")

    def write(batch, batch_id):
        layout.overwrite_partitions(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), out, ["batch_id"])

    stream = streams.like_static(t.spark, write_events(t), bytes_per_batch=BATCH).select("event_id", "event_type")
    drain(batch_stream(stream, write, t.scratch("foreach-ck")))
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "snk17_partition_control",
    """SELECT * FROM (SELECT count(*) AS n_rows FROM orders), (VALUES ('coalesce', true), ('repartition_n', true), ('repartition_n_key', true)) v(layout, within)""",
)
def _(t):
    """Rows and partitions after each kind of repartitioning; by key the balance is computed before any row moves."""
    n = shuffle_partitions(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey")
    laid = {
        "coalesce": layout.partition_balance(rows.repartition(2 * n).coalesce(n)),
        "repartition_n": layout.partition_balance(rows.repartition(n)),
        "repartition_n_key": layout.predicted_balance(rows, ["o_custkey"], n),
    }
    reports = [
        balance.agg(F.sum("n_rows").alias("n_rows"), (F.count(F.lit(1)) <= n).alias("within")).withColumn("layout", F.lit(name))
        for name, balance in laid.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query(
    "snk18_reused_intermediate",
    f"""WITH d AS (SELECT o_custkey, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY o_custkey)
        SELECT o_custkey, total, (SELECT count(*) FROM d) AS n_customers FROM d WHERE total > 1000000""",
)
def _(t):
    """One aggregate, two actions: the first keeps it, the second reads it from where it is kept."""
    per_customer = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total"))
    path = t.scratch("reused")
    with layout.reused(per_customer) as kept:
        n = kept.count()
        kept.filter(F.col("total") > 1000000).withColumn("n_customers", F.lit(n).cast("long")).write.parquet(path)
    return t.spark.read.parquet(path)
