"""Windows, sorting and top-k (WIN, SRT)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.money import exact_sum
from lakeops.operators import windows as win
from lakeops.queries.registry import HOT_SQL, hot_orders, query, sum_sql

HOT = f"(SELECT o_orderkey, {HOT_SQL} AS custkey, o_totalprice, o_orderdate, o_orderstatus FROM orders)"

# Events, and again the rows of every seventh event one hour later with the value raised.
VERSIONS_SQL = (
    "(SELECT event_id, user_id, ts, value, ts + INTERVAL 1 MINUTE AS ingest_ts FROM events UNION ALL "
    "SELECT event_id, user_id, ts + INTERVAL 1 HOUR, value + 1, ts + INTERVAL 2 HOUR FROM events WHERE event_id % 7 = 0 UNION ALL "
    "SELECT event_id, user_id, ts - INTERVAL 1 HOUR, value + 2, NULL FROM events WHERE event_id % 14 = 0)"
)


def versions(t):
    """Events with corrections: a later one for every 7th, an earlier one without ingest time for every 14th."""
    e = t.events.select("event_id", "user_id", "ts", "value", (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("ingest_ts"))
    late = e.filter("event_id % 7 = 0").select(
        "event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), (F.col("value") + 1).alias("value"),
        (F.col("ts") + F.expr("INTERVAL 2 HOUR")).alias("ingest_ts"),
    )
    early = e.filter("event_id % 14 = 0").select(
        "event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("ts"), (F.col("value") + 2).alias("value"),
        F.lit(None).cast("timestamp_ntz").alias("ingest_ts"),
    )
    return e.unionByName(late).unionByName(early)


@query(
    "win01_row_number",
    f"SELECT o_orderkey, custkey, row_number() OVER (PARTITION BY custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {HOT}",
)
def _(t):
    rows = hot_orders(t).select("o_orderkey", "custkey", "o_orderdate")
    numbered = win.ordered_numbers(rows, ["custkey"], ["-o_orderdate", "-o_orderkey"], row_number="rn")
    return numbered.drop("o_orderdate")


@query("win02_rank", f"SELECT o_orderkey, custkey, rank() OVER (PARTITION BY custkey ORDER BY o_orderdate) AS rk FROM {HOT}")
def _(t):
    rows = hot_orders(t).select("o_orderkey", "custkey", "o_orderdate")
    return win.ranks(rows, ["custkey"], ["o_orderdate"], rank="rk").drop("o_orderdate")


@query(
    "win03_dense_rank",
    f"SELECT o_orderkey, o_orderstatus, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS drk FROM {HOT}",
)
def _(t):
    """Three groups for the whole table: each is far larger than one task should hold."""
    rows = hot_orders(t).select("o_orderkey", "o_orderstatus", "o_orderdate")
    return win.ranks(rows, ["o_orderstatus"], ["-o_orderdate"], dense_rank="drk").drop("o_orderdate")


@query(
    "win04_latest_per_key",
    f"SELECT * FROM {VERSIONS_SQL} QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC NULLS LAST, ingest_ts DESC NULLS LAST) = 1",
)
def _(t):
    return win.latest(versions(t), ["event_id"], ["ts", "ingest_ts"])


@query(
    "win05_latest_by_ingest",
    f"SELECT * FROM {VERSIONS_SQL} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingest_ts DESC NULLS LAST, ts DESC NULLS LAST, event_id DESC) = 1",
)
def _(t):
    return win.latest(versions(t), ["user_id"], ["ingest_ts", "ts", "event_id"])


@query(
    "win06_top_n_per_group",
    f"""SELECT * FROM (SELECT date_trunc('month', o_orderdate)::DATE AS month, o_custkey, {sum_sql('o_totalprice')} AS revenue FROM orders GROUP BY 1, 2)
        QUALIFY dense_rank() OVER (PARTITION BY month ORDER BY revenue DESC) <= 10""",
)
def _(t):
    revenue = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month"), "o_custkey").agg(exact_sum("o_totalprice").alias("revenue"))
    return win.top_n(revenue, ["month"], ["-revenue"], 10, "dense_rank").drop("rn")


@query(
    "win07_lag_lead",
    f"""SELECT o_orderkey, custkey, o_totalprice, lag(o_totalprice) OVER w AS previous, lead(o_totalprice) OVER w AS following FROM {HOT}
        WINDOW w AS (PARTITION BY custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t):
    rows = hot_orders(t).select("o_orderkey", "custkey", "o_orderdate", "o_totalprice")
    return win.ordered_numbers(
        rows, ["custkey"], ["o_orderdate", "o_orderkey"], lag={"previous": "o_totalprice"}, lead={"following": "o_totalprice"}
    ).drop("o_orderdate")


@query(
    "win08_keep_first_last",
    f"""SELECT custkey, max(o_totalprice) FILTER (WHERE o_orderdate = hi) AS last_max, min(o_totalprice) FILTER (WHERE o_orderdate = lo) AS first_min
        FROM {HOT} JOIN (SELECT {HOT_SQL} AS custkey, max(o_orderdate) AS hi, min(o_orderdate) AS lo FROM orders GROUP BY 1) USING (custkey) GROUP BY custkey""",
)
def _(t):
    return hot_orders(t).groupBy("custkey").agg(
        win.keep_last_max("o_orderdate", "o_totalprice").alias("last_max"),
        win.keep_first_min("o_orderdate", "o_totalprice").alias("first_min"),
    )


@query(
    "win09_qualify",
    f"SELECT o_orderkey, custkey, o_totalprice FROM {HOT} QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3",
)
def _(t):
    rows = hot_orders(t).select("o_orderkey", "custkey", "o_totalprice")
    w = Window.partitionBy("custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return win.qualify(rows, F.row_number().over(w), F.col("q") <= 3)


@query(
    "srt01_global_sort",
    f"SELECT o_orderstatus, o_orderpriority, o_custkey, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY ALL ORDER BY 1, 2, 3",
)
def _(t):
    keys = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    return t.orders.groupBy(*keys).agg(exact_sum("o_totalprice").alias("total")).orderBy(*keys)


@query(
    "srt02_desc_nulls_last",
    "SELECT event_id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE ts END AS ts FROM events ORDER BY ts DESC NULLS LAST, event_id",
)
def _(t):
    rows = t.events.select("event_id", F.when(F.col("event_id") % 19 != 0, F.col("ts")).alias("ts"))
    return rows.orderBy(F.desc_nulls_last("ts"), "event_id")


@query("srt03_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("srt04_ordered_limit", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 500")
def _(t):
    """A limit is offered only with a total order: without one its rows differ from run to run."""
    return t.events.select("event_id", "ts").orderBy("ts", "event_id").limit(500)
