"""Whole jobs (PIP)."""

from datetime import date

from pyspark.sql import functions as F

from lakeops.functions.conditional import banded
from lakeops.operators.aggregate import kpi
from lakeops.operators.governance import runs
from lakeops.operators.joins import Dim, star_join
from lakeops.operators.layout import overwrite_partitions
from lakeops.plans import kpi as jobs
from lakeops.queries.merges import MERGED_SQL, late_batch, silver_orders
from lakeops.queries.registry import HOT_SQL, Tables, avg_sql, decimal_sum_sql, hot_orders, query, sum_sql, thousandths, thousandths_sql
from lakeops.queries.streams import WIRE_SQL, feed, opened, wire
from lakeops.operators.merge import Keyed
from lakeops.operators.quality import not_null_rules, positive_rule
from lakeops.streaming.gold import ChangeGold
from lakeops.streaming.silver import Upsert, gold_refresh
from lakeops.streaming.sinks import append_stream, batch_stream

PERIOD_SQL = "o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-07-01'"


def customer_dim(t: Tables, columns=("c_mktsegment",)):
    return Dim(t.customer, "o_custkey", "c_custkey", list(columns))


def period():
    day = F.col("o_orderdate")
    return (day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("2001-07-01").cast("timestamp_ntz"))


def period_kpi(t: Tables, strategy: str):
    orders = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", F.to_date("o_orderdate").alias("dt"))
    return jobs.period_kpi(orders, customer_dim(t), period(), ["dt", "o_orderstatus", "c_mktsegment"], "o_totalprice", strategy)


PERIOD_KPI_SQL = (
    f"SELECT CAST(o_orderdate AS DATE) AS dt, o_orderstatus, c_mktsegment, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount, {avg_sql('o_totalprice')} AS avg_amount "
    f"FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {PERIOD_SQL} GROUP BY 1, 2, 3"
)


@query(
    "pip01_enrich_silver",
    "SELECT o_orderkey, o_totalprice, c_mktsegment, c_name, CASE WHEN o_totalprice < 1000 THEN 'LOW' WHEN o_totalprice < 3000 THEN 'MID' ELSE 'HIGH' END AS amount_bucket, "
    "CAST(o_orderdate AS DATE) AS dt FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(t):
    enriched = jobs.enrich(t.orders, [customer_dim(t, ["c_mktsegment", "c_name"])], "o_orderdate", "o_totalprice")
    return enriched.select("o_orderkey", "o_totalprice", "c_mktsegment", "c_name", "amount_bucket", "dt")


@query("pip02_period_kpi", PERIOD_KPI_SQL)
def _(t):
    return period_kpi(t, "broadcast")


@query("pip02_period_kpi_merge", PERIOD_KPI_SQL)
def _(t):
    return period_kpi(t, "merge")


@query("pip02_period_kpi_auto", PERIOD_KPI_SQL)
def _(t):
    return period_kpi(t, "auto")


@query(
    "pip02_exact_kpi",
    f"SELECT CAST(o_orderdate AS DATE) AS dt, o_orderstatus, c_mktsegment, count(*) AS txns, {decimal_sum_sql(thousandths_sql('o_totalprice', 'o_orderkey'))} AS total_amount "
    f"FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {PERIOD_SQL} GROUP BY 1, 2, 3",
)
def _(t):
    """Amounts of three digits behind the point, summed exactly as doubles."""
    orders = t.orders.withColumns({"dt": F.to_date("o_orderdate"), "amount": thousandths("o_totalprice", "o_orderkey")})
    out = jobs.period_kpi(orders, customer_dim(t), period(), ["dt", "o_orderstatus", "c_mktsegment"], "amount", scale=None)
    return out.select("dt", "o_orderstatus", "c_mktsegment", "txns", F.round("total_amount", 3).alias("total_amount"))


TIERS = [(0, "TIER_3"), (5000, "TIER_2")]
TIER_SQL = "CASE WHEN s_acctbal IS NULL THEN NULL WHEN s_acctbal < 0 THEN 'TIER_3' WHEN s_acctbal < 5000 THEN 'TIER_2' ELSE 'TIER_1' END"


@query(
    "pip03_star_kpi",
    f"""SELECT l_returnflag, c_mktsegment, {TIER_SQL} AS tier, p_brand, count(*) AS txns, {sum_sql('l_extendedprice')} AS total_amount, {avg_sql('l_extendedprice')} AS avg_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""",
)
def _(t):
    fact = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag", "l_extendedprice").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    )
    merchants = t.supplier.select("s_suppkey", banded("s_acctbal", TIERS, "TIER_1").alias("tier"))
    dims = [customer_dim(t), Dim(merchants, "l_suppkey", "s_suppkey", ["tier"]), Dim(t.part, "l_partkey", "p_partkey", ["p_brand"])]
    return jobs.star_kpi(fact, dims, ["l_returnflag", "c_mktsegment", "tier", "p_brand"], "l_extendedprice")


DAY = date(1997, 5, 1)
DAY_SQL = "date_trunc('month', o_orderdate) = TIMESTAMP '1997-05-01'"


@query(
    "pip04_governed_gold",
    f"""WITH g AS (SELECT c_mktsegment, o_orderstatus, count(*) AS txns, {sum_sql('o_totalprice')} AS total FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {DAY_SQL} GROUP BY 1, 2)
        SELECT 'txns' AS "check", CAST(sum(txns) AS DOUBLE) AS source_value, CAST(sum(txns) AS DOUBLE) AS target_value, true AS ok, 'SUCCESS' AS status FROM g
        UNION ALL SELECT 'total_amount', {sum_sql('total')}, {sum_sql('total')}, true, 'SUCCESS' FROM g
        UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE), CAST(count(*) AS DOUBLE), true, 'SUCCESS' FROM g
        UNION ALL SELECT unnest(['duplicate_keys', 'missing_keys', 'unexpected_keys']), 0, 0, true, 'SUCCESS'""",
)
def _(t):
    """One month of Silver published to Gold, logged and reconciled."""
    silver, gold, log = silver_orders(t), t.scratch("gold"), t.scratch("runs")
    checks = jobs.governed_day(
        t.spark, silver.path, gold, DAY, [customer_dim(t)], ["c_mktsegment", "o_orderstatus"], "o_totalprice", log, t.scratch("registry"), "month"
    )
    status = runs(t.spark, log).agg(F.max("status").alias("s")).scalar()
    return checks.withColumn("status", status)


@query(
    "pip05_late_data_gold",
    f"SELECT month, c_mktsegment, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount, {avg_sql('o_totalprice')} AS avg_amount FROM ({MERGED_SQL}) LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def _(t):
    """Gold from Silver, then a late batch merged and the touched months of Gold rebuilt."""
    silver, gold, dims = silver_orders(t), t.scratch("gold"), [customer_dim(t)]
    first = jobs.star_kpi(t.spark.read.parquet(silver.path), dims, ["month", "c_mktsegment"], "o_totalprice")
    overwrite_partitions(first, gold, ["month"])
    jobs.late_data(t.spark, silver, late_batch(t), gold, dims, ["c_mktsegment"], "o_totalprice")
    return t.spark.read.parquet(gold)


@query(
    "pip05_late_data_by_changes",
    f"""SELECT month, c_mktsegment, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount, {avg_sql('o_totalprice')} AS avg_amount, min(o_totalprice) AS min_amount,
        max(o_totalprice) AS max_amount FROM ({MERGED_SQL}) LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(t):
    """The same late batch, run twice as after a crash: Gold gets the differences, once."""
    silver = silver_orders(t, indexed=True)
    gold = ChangeGold(t.scratch("gold"), ["month", "c_mktsegment"], ["month"], "o_totalprice", prepare=lambda rows: star_join(rows, [customer_dim(t)]))
    for _ in range(2):
        jobs.late_data_changes(t.spark, silver, late_batch(t), gold, 1)
    return gold.read(t.spark)


@query(
    "pip06_stream_to_gold",
    f"SELECT dt, channel, count(*) AS txns, {sum_sql('amount')} AS total_amount, {avg_sql('amount')} AS avg_amount FROM ({WIRE_SQL}) WHERE order_id IS NOT NULL AND event_ts IS NOT NULL AND amount > 0 GROUP BY 1, 2",
)
def _(t):
    """Envelope to Bronze by one stream; Bronze to Silver and Gold by a second."""
    bronze, gold = t.scratch("bronze"), t.scratch("gold")
    feed(t, [wire(t)], lambda s, ck: append_stream(opened(s), bronze, ck))
    table = Keyed(t.scratch("silver"), ["order_id"], ["event_ts", "kafka_ts"], ["dt"])
    rules = {**not_null_rules(["order_id", "event_ts"]), **positive_rule("amount")}
    sink = Upsert(table, rules, gold=gold_refresh(gold, ["dt"], lambda s: kpi(s, ["dt", "channel"], "amount")))
    feed(t, [t.spark.read.parquet(bronze)], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(gold)


@query(
    "pip07_skewed_segments",
    f"""SELECT c_mktsegment, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS txns, {sum_sql('total')} AS total_amount FROM
        (SELECT {HOT_SQL} AS custkey, count(*) AS n, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY 1) LEFT JOIN customer ON custkey = c_custkey GROUP BY 1""",
)
def _(t):
    dim = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    return jobs.skewed_segment_kpi(hot_orders(t), dim, "custkey", "c_mktsegment", "o_totalprice", ["o_orderkey"])


@query(
    "pip08_daily_revenue",
    f"""SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS txns, count(*) FILTER (WHERE o_orderstatus = 'F') AS success_txns,
        coalesce({sum_sql("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")}, 0) AS revenue FROM orders GROUP BY 1""",
)
def _(t):
    return jobs.daily_revenue(t.orders, "o_orderdate", "o_totalprice", F.col("o_orderstatus") == "F")


@query(
    "pip08_top_customers",
    f"""SELECT dt, custkey, revenue, dense_rank() OVER (PARTITION BY dt ORDER BY revenue DESC) AS revenue_rank FROM
        (SELECT CAST(o_orderdate AS DATE) AS dt, {HOT_SQL} AS custkey, {sum_sql('o_totalprice')} AS revenue FROM orders GROUP BY 1, 2) QUALIFY revenue_rank <= 10""",
)
def _(t):
    return jobs.top_customers(hot_orders(t), "o_orderdate", "custkey", "o_totalprice", 10)
