"""Projections and filters (PRJ, FLT)."""

from datetime import date

from pyspark.sql import functions as F

from lakeops.functions.nested import flatten_struct
from lakeops.operators.joins import prefixed
from lakeops.queries.registry import MONTH_SQL, query
from lakeops.queries.sinks import monthly_table
from lakeops.sources.tables import day_range, on_day


@query("prj01_select_alias", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def _(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount")
    )


@query("prj02_select_expr", "SELECT CAST(event_id AS VARCHAR) AS id_text, upper(event_type) AS kind, value * 2 AS twice FROM events")
def _(t):
    return t.events.selectExpr("CAST(event_id AS STRING) AS id_text", "upper(event_type) AS kind", "value * 2 AS twice")


@query(
    "prj03_derived_columns",
    "SELECT o_orderkey, o_totalprice * 0.015 AS fee, CAST(o_orderdate AS DATE) AS dt, o_orderstatus = 'F' AS is_final FROM orders",
)
def _(t):
    """Many columns in one projection instead of a chain of single additions."""
    made = t.orders.withColumns(
        {"fee": F.col("o_totalprice") * 0.015, "dt": F.to_date("o_orderdate"), "is_final": F.col("o_orderstatus") == "F"}
    )
    return made.select("o_orderkey", "fee", "dt", "is_final")


@query("prj04_rename_drop", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_orderdate FROM orders")
def _(t):
    return t.orders.withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"}).drop("o_totalprice", "o_orderpriority")


@query("prj05_struct_flatten", "SELECT user_id, event_type, value, event_id FROM events")
def _(t):
    nested = t.events.select(F.struct("user_id", "event_type", "value").alias("o"), "event_id")
    return flatten_struct(nested, "o")


@query(
    "prj06_prefixed_join",
    "SELECT n.n_nationkey, n.n_name, r.r_regionkey AS r_r_regionkey, r.r_name AS r_r_name, c.c_custkey "
    "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey",
)
def _(t):
    region = prefixed(t.region, "r_")
    places = t.nation.join(region, F.col("n_regionkey") == F.col("r_r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "n_name", "r_r_regionkey", "r_r_name", "c_custkey"
    )


@query("flt01_conjunction", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def _(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)).select("o_orderkey", "o_totalprice")


@query(
    "flt02_half_open_range",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'",
)
def _(t):
    return day_range(t.orders, "o_orderdate", "1996-01-01", "1996-07-01").select("o_orderkey", "o_orderdate")


@query(
    "flt03_between_in_like",
    "SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%HIGH%'",
)
def _(t):
    o = t.orders
    keep = o.o_totalprice.between(1000, 200000) & o.o_orderstatus.isin("F", "O") & o.o_orderpriority.like("%HIGH%")
    return o.filter(keep).select("o_orderkey")


@query(
    "flt04_drop_null_keys",
    "SELECT event_id, user_id, v FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id, "
    "CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END AS v FROM events) WHERE user_id IS NOT NULL AND v IS NOT NULL",
)
def _(t):
    dirty = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 13 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 19 != 0, F.col("value")).alias("v"),
    )
    return dirty.na.drop(subset=["user_id", "v"])


@query("flt05_regex", "SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, '^[A-Z]+ .*(STEEL|BRASS)$') OR regexp_matches(p_name, '[0-9]$')")
def _(t):
    keep = F.col("p_type").rlike("^[A-Z]+ .*(STEEL|BRASS)$") | F.col("p_name").rlike("[0-9]$")
    return t.part.filter(keep).select("p_partkey", "p_type")


@query(
    "flt06_day_keeps_pruning",
    f"SELECT o_orderkey, o_orderdate, {MONTH_SQL} AS month FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-02-01'",
)
def _(t):
    """A predicate on the timestamp plus the partition predicate that follows from it."""
    table = t.spark.read.parquet(monthly_table(t))
    return on_day(table, date(1998, 2, 1), "month", "o_orderdate").select("o_orderkey", "o_orderdate", "month")


@query(
    "flt06_day_within_month",
    f"SELECT o_orderkey, o_orderdate, {MONTH_SQL} AS month FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-02-17'",
)
def _(t):
    """A day in the middle of a partition's month."""
    table = t.spark.read.parquet(monthly_table(t))
    return on_day(table, date(1998, 2, 17), "month", "o_orderdate", "month").select("o_orderkey", "o_orderdate", "month")


@query("flt07_raw_column_predicate", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def _(t):
    return t.customer.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)).select("c_custkey", "c_mktsegment")


@query(
    "flt08_cdc_delete_filter",
    "SELECT event_id, op FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'D' WHEN event_id % 7 = 0 THEN 'U' WHEN event_id % 3 = 0 THEN NULL ELSE 'I' END AS op FROM events) WHERE op IS NULL OR op <> 'D'",
)
def _(t):
    e = F.col("event_id")
    op = F.when(e % 11 == 0, "D").when(e % 7 == 0, "U").when(e % 3 == 0, F.lit(None)).otherwise("I")
    return t.events.select("event_id", op.alias("op")).filter(~F.col("op").eqNullSafe(F.lit("D")))
