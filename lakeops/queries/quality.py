"""Data quality and governance (DQ, GOV)."""

from pyspark.sql import functions as F

from lakeops.functions.money import exact_sum
from lakeops.operators import governance as gov
from lakeops.operators import quality as dq
from lakeops.operators import skew
from lakeops.queries.registry import HOT_SQL, ORACLES, hot_orders, query, sum_sql
from lakeops.queries.streams import DIRTY_SQL, dirty, rules

FAILED_SQL = """concat_ws(',', CASE WHEN user_id IS NULL THEN 'user_id_not_null' END, CASE WHEN ts IS NULL THEN 'ts_not_null' END,
    CASE WHEN value IS NULL OR value <= 0 THEN 'value_positive' END)"""


@query("dq01_split", f"SELECT event_id, {FAILED_SQL} AS failed, {FAILED_SQL} = '' AS good FROM ({DIRTY_SQL} UNION ALL SELECT * FROM ({DIRTY_SQL}) WHERE event_id % 5 = 0)")
def _(t):
    """Both sides of the split together; exact copies of good rows stay, as in the input."""
    rows = dirty(t)
    good, bad = dq.split_rules(rows.unionByName(rows.filter("event_id % 5 = 0")), rules())
    marked = good.select("event_id", F.lit("").alias("failed"), F.lit(True).alias("good"))
    return marked.unionByName(bad.select("event_id", F.array_join(dq.FAILED, ",").alias("failed"), F.lit(False).alias("good")))


@query(
    "dq02_metrics",
    f"""SELECT count(*) AS input_rows, count(*) FILTER (WHERE f = '') AS good_rows, count(*) FILTER (WHERE f <> '') AS dq_failed_rows,
        CAST(0 AS BIGINT) AS failed_event_id_not_null, count(*) FILTER (WHERE f LIKE '%user_id%') AS failed_user_id_not_null,
        count(*) FILTER (WHERE f LIKE '%ts_not%') AS failed_ts_not_null, count(*) FILTER (WHERE f LIKE '%value%') AS failed_value_positive
        FROM (SELECT {FAILED_SQL} AS f FROM ({DIRTY_SQL}))""",
)
def _(t):
    return dq.rule_metrics(dirty(t), rules())


@query("dq02_observed_by_the_write", ORACLES["dq02_metrics"])
def _(t):
    """The same metrics, taken by the pass that writes the good rows and the others."""
    rows, seen = dq.observed_rules(dirty(t), rules())
    good = dq._all_hold(rules())
    rows.withColumn("good", F.coalesce(good, F.lit(False))).write.partitionBy("good").parquet(t.scratch("observed"))
    return t.spark.createDataFrame([seen.get])


@query("dq03_quarantine", f"SELECT event_id, {FAILED_SQL} AS failed, 'run-1' AS run_id FROM ({DIRTY_SQL}) WHERE {FAILED_SQL} <> ''")
def _(t):
    _, bad = dq.split_rules(dirty(t), rules())
    path = dq.quarantine(bad, t.scratch("quarantine"), "run-1")
    return t.spark.read.parquet(path).select("event_id", F.array_join(dq.FAILED, ",").alias("failed"), "run_id")


@query(
    "dq04_reconcile",
    f"""WITH s AS (SELECT o_orderkey, o_totalprice FROM orders), t AS (SELECT * FROM s WHERE o_orderkey % 100 <> 3 UNION ALL SELECT * FROM s WHERE o_orderkey % 50 = 0
          UNION ALL SELECT -1 - o_orderkey, o_totalprice FROM s WHERE o_orderkey % 200 = 0),
        v AS (SELECT 'rows' AS "check", CAST((SELECT count(*) FROM s) AS DOUBLE) AS source_value, CAST((SELECT count(*) FROM t) AS DOUBLE) AS target_value
          UNION ALL SELECT 'amount', (SELECT {sum_sql('o_totalprice')} FROM s), (SELECT {sum_sql('o_totalprice')} FROM t)
          UNION ALL SELECT 'duplicate_keys', 0, (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0 AND o_orderkey % 100 <> 3)
          UNION ALL SELECT 'missing_keys', 0, (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 3)
          UNION ALL SELECT 'unexpected_keys', 0, (SELECT count(*) FROM orders WHERE o_orderkey % 200 = 0))
        SELECT *, source_value = target_value AS ok FROM v""",
)
def _(t):
    """A copy of the orders with rows lost, doubled and added."""
    k = F.col("o_orderkey")
    source = t.orders.select("o_orderkey", "o_totalprice")
    added = source.filter(k % 200 == 0).withColumn("o_orderkey", -1 - k)
    target = source.filter(k % 100 != 3).unionByName(source.filter(k % 50 == 0)).unionByName(added)
    return dq.reconcile(source, target, ["o_orderkey"], {"amount": exact_sum("o_totalprice")})


@query(
    "dq04_changed_rows",
    """SELECT o_orderkey, 'missing' AS change, CAST(1 AS BIGINT) AS source_rows, CAST(0 AS BIGINT) AS target_rows FROM orders WHERE o_orderkey % 100 = 3
       UNION ALL SELECT o_orderkey, 'changed', 1, 1 FROM orders WHERE o_orderkey % 500 IN (7, 9)
       UNION ALL SELECT o_orderkey, 'count', 1, 2 FROM orders WHERE o_orderkey % 50 = 0
       UNION ALL SELECT -1 - o_orderkey, 'unexpected', 0, 1 FROM orders WHERE o_orderkey % 200 = 0""",
)
def _(t):
    """A copy of the orders with rows lost, doubled and added, prices changed and statuses lost."""
    k = F.col("o_orderkey")
    source = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    price = F.when(k % 500 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = source.withColumns({"o_totalprice": price, "o_orderstatus": F.when(k % 500 != 9, F.col("o_orderstatus"))}).filter(k % 100 != 3)
    added = source.filter(k % 200 == 0).withColumn("o_orderkey", -1 - k)
    return dq.changed_rows(source, kept.unionByName(source.filter(k % 50 == 0)).unionByName(added), ["o_orderkey"])


@query(
    "dq05_schema_drift",
    """SELECT * FROM (VALUES ('o_orderpriority', 'string', NULL, 'removed'), ('o_custkey', 'bigint', 'string', 'retyped'), ('channel', NULL, 'string', 'added')) v(column_name, old_type, new_type, change)
       JOIN (SELECT 'o_orderpriority' AS column_name, count(o_orderpriority) AS n_filled FROM orders UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders
             UNION ALL SELECT 'channel', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders) USING (column_name)""",
)
def _(t):
    """Two written snapshots of the orders, and how many values each changed column holds."""
    new_path = t.scratch("drift")
    channel = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    t.orders.withColumns({"channel": channel, "o_custkey": F.col("o_custkey").cast("string")}).drop("o_orderpriority").write.parquet(new_path)
    old, new = t.orders, t.spark.read.parquet(new_path)
    drift = dq.schema_drift(t.spark, old.schema, new.schema)
    filled_old = old.agg(*[F.count(c).alias(c) for c in old.columns])
    filled_new = new.agg(*[F.count(c).alias(c) for c in new.columns if c not in old.columns])
    filled = filled_old.unpivot([], list(filled_old.columns), "column_name", "n_filled").unionByName(
        filled_new.unpivot([], list(filled_new.columns), "column_name", "n_filled")
    )
    return drift.join(filled, "column_name")


@query(
    "dq06_skew_metric",
    f"""SELECT run_id, custkey, n_rows, CAST(n_rows AS DOUBLE) / (SELECT count(*) FROM orders) AS share, n_rows > 0.05 * (SELECT count(*) FROM orders) AS is_hot
        FROM (SELECT {HOT_SQL} AS custkey, count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY n_rows DESC, custkey LIMIT 5), (VALUES ('run-1'), ('run-2')) r(run_id)""",
)
def _(t):
    """The profile of each run appended to one metrics table."""
    path = t.scratch("skew-metrics")
    for run_id in ("run-1", "run-2"):
        skew.skew_profile(hot_orders(t), "custkey", 5).withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


RUN_COLUMNS = ["job_name", "batch_id", "source_path", "input_rows", "output_rows", "dq_failed_rows", "status"]


@query(
    "gov01_run_log",
    f"""SELECT 'load_events' AS job_name, b.batch_id, 'events' AS source_path, b.n AS input_rows, b.good AS output_rows, b.n - b.good AS dq_failed_rows, 'SUCCESS' AS status FROM
        (SELECT CAST(event_id % 2 AS BIGINT) AS batch_id, count(*) AS n, count(*) FILTER (WHERE {FAILED_SQL} = '') AS good FROM ({DIRTY_SQL}) GROUP BY 1
         UNION ALL SELECT NULL, count(*), count(*) FILTER (WHERE {FAILED_SQL} = '') FROM ({DIRTY_SQL})) b""",
)
def _(t):
    """A batch run and two stream batches in one log of one schema."""
    log = t.scratch("runs")
    rows = dirty(t)
    for batch_id, part in ((None, rows), (0, rows.filter("event_id % 2 = 0")), (1, rows.filter("event_id % 2 = 1"))):
        with gov.job_run(t.spark, log, "load_events", "events", "silver", batch_id) as run:
            m = dq.rule_metrics(part, rules()).first()
            run.input_rows, run.output_rows, run.dq_failed_rows = m["input_rows"], m["good_rows"], m["dq_failed_rows"]
    return gov.runs(t.spark, log).select(*RUN_COLUMNS)


@query(
    "gov02_failed_run",
    """SELECT 'ok_job' AS job_name, (SELECT count(*) FROM customer) AS input_rows, 'SUCCESS' AS status, '' AS error, false AS raised UNION ALL
       SELECT 'bad_job', (SELECT count(*) FROM orders), 'FAILED', 'ValueError: amounts do not add up', true""",
)
def _(t):
    """A run that fails is logged with its error, and the error still reaches the caller."""
    log, raised = t.scratch("runs"), False
    with gov.job_run(t.spark, log, "ok_job", "customer", "x") as run:
        run.input_rows = t.customer.count()
    try:
        with gov.job_run(t.spark, log, "bad_job", "orders", "x") as run:
            run.input_rows = t.orders.count()
            raise ValueError("amounts do not add up")
    except ValueError:
        raised = True
    out = gov.runs(t.spark, log).select("job_name", "input_rows", "status", F.col("error_message").alias("error"))
    return out.withColumn("raised", (F.col("job_name") == "bad_job") & F.lit(raised))


@query(
    "gov03_schema_registry",
    "SELECT * FROM (VALUES ('orders', 2, 7), ('customer', 1, 5)) v(dataset_name, n_snapshots, last_columns) JOIN (SELECT 'orders' AS dataset_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer) USING (dataset_name)",
)
def _(t):
    """A snapshot is added only when the schema differs from the last one."""
    registry, versions = t.scratch("registry"), [t.orders, t.orders, t.orders.withColumn("channel", F.lit("POS"))]
    for df in versions:
        gov.snapshot_schema(t.spark, df.schema, "orders", t.path("orders"), registry)
    for _ in range(2):
        gov.snapshot_schema(t.spark, t.customer.schema, "customer", t.path("customer"), registry)
    sizes = t.orders.agg(F.lit("orders").alias("dataset_name"), F.count(F.lit(1)).alias("n_rows")).unionByName(
        t.customer.agg(F.lit("customer").alias("dataset_name"), F.count(F.lit(1)).alias("n_rows"))
    )
    width = F.size(F.from_json(F.get_json_object("schema_json", "$.fields"), "array<struct<name: string>>"))
    snaps = t.spark.read.parquet(registry).groupBy("dataset_name").agg(
        F.count(F.lit(1)).cast("int").alias("n_snapshots"), F.max_by(width, "snap_at").alias("last_columns")
    )
    return snaps.join(sizes, "dataset_name")


@query(
    "gov04_lineage",
    """WITH RECURSIVE e AS (SELECT DISTINCT * FROM (
         SELECT 'raw_' || event_type AS s, 'bronze_' || user_id AS t FROM events WHERE event_id % 13 <> 0 UNION ALL SELECT 'bronze_' || user_id, 'silver_' || user_id % 10 FROM events WHERE event_id % 13 <> 0
         UNION ALL SELECT 'silver_' || user_id % 10, 'gold' FROM events WHERE event_id % 13 <> 0)),
       w AS (SELECT s, t, CAST(1 AS BIGINT) AS hops FROM e UNION SELECT w.s, e.t, hops + 1 FROM w JOIN e ON w.t = e.s)
       SELECT s AS source, t AS target, min(hops) AS hops FROM w GROUP BY s, t""",
)
def _(t):
    """Runs logged per event: raw by type, bronze by user, silver by group of users, gold. Failed runs make no edge."""
    return gov.lineage(event_runs(t))


@query(
    "gov04_lineage_from_tables",
    """WITH RECURSIVE e AS (SELECT DISTINCT * FROM (
         SELECT 'raw_' || event_type AS s, 'bronze_' || user_id AS t FROM events WHERE event_id % 13 <> 0 UNION ALL SELECT 'bronze_' || user_id, 'silver_' || user_id % 10 FROM events WHERE event_id % 13 <> 0
         UNION ALL SELECT 'silver_' || user_id % 10, 'gold' FROM events WHERE event_id % 13 <> 0)),
       w AS (SELECT s, t, CAST(1 AS BIGINT) AS hops FROM e WHERE s IN ('raw_click', 'bronze_7', 'no such table') UNION SELECT w.s, e.t, hops + 1 FROM w JOIN e ON w.t = e.s)
       SELECT s AS source, t AS target, min(hops) AS hops FROM w GROUP BY s, t""",
)
def _(t):
    """What depends on the named tables, by the runs of `gov04_lineage`; the walk starts at these tables only."""
    return gov.lineage(event_runs(t), ["raw_click", "bronze_7", "no such table"])


def event_runs(t):
    u = F.col("user_id")
    status = F.when(F.col("event_id") % 13 == 0, "FAILED").otherwise("SUCCESS").alias("status")

    def edge(source, target):
        return t.events.select(source.alias("source_path"), target.alias("target_path"), status)

    bronze = F.concat(F.lit("bronze_"), u.cast("string"))
    silver = F.concat(F.lit("silver_"), (u % 10).cast("string"))
    return edge(F.concat(F.lit("raw_"), "event_type"), bronze).unionAll(edge(bronze, silver)).unionAll(edge(silver, F.lit("gold")))
