"""Group aggregates (AGG)."""

from pyspark.sql import functions as F

from lakeops.functions.money import exact_avg, exact_sum
from lakeops.operators import aggregate as agg
from lakeops.operators import skew
from lakeops.operators.joins import join_as
from lakeops.queries.registry import HOT_SQL, avg_sql, decimal_sum_sql, hot_orders, query, sum_sql, thousandths, thousandths_sql, units_sql

TOTALS = f"SELECT {HOT_SQL} AS custkey, count(*) AS n_rows, {sum_sql('o_totalprice')} AS total, {avg_sql('o_totalprice')} AS average FROM orders GROUP BY 1"


@query("agg01_count_by_key", "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "agg02_sum_avg_min_max",
    f"SELECT l_returnflag, l_linestatus, {sum_sql('l_extendedprice')} AS total, {avg_sql('l_quantity')} AS avg_qty, "
    "min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        exact_sum("l_extendedprice").alias("total"),
        exact_avg("l_quantity").alias("avg_qty"),
        F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"),
    )


@query(
    "agg03_kpi",
    f"SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS txns, {sum_sql('l_extendedprice')} AS total_amount, "
    f"{avg_sql('l_extendedprice')} AS avg_amount FROM lineitem GROUP BY ALL",
)
def _(t):
    return agg.kpi(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_extendedprice")


@query(
    "agg04_daily_kpi",
    f"SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS txns, {sum_sql('value')} AS total_amount, {avg_sql('value')} AS avg_amount FROM events GROUP BY 1, 2",
)
def _(t):
    return agg.daily_kpi(t.events, "ts", ["event_type"], "value")


_FINE = thousandths_sql("l_extendedprice", "l_orderkey")


@query(
    "agg03_kpi_exact",
    f"SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS txns, {decimal_sum_sql(_FINE)} AS total_amount FROM lineitem GROUP BY ALL",
)
def _(t):
    """Amounts in thousandths, as doubles: exact totals, rounded for show only."""
    rows = t.lineitem.withColumn("amount", thousandths("l_extendedprice", "l_orderkey"))
    out = agg.kpi(rows, ["l_returnflag", "l_linestatus", "l_linenumber"], "amount", None)
    return out.select("l_returnflag", "l_linestatus", "l_linenumber", "txns", F.round("total_amount", 3).alias("total_amount"))


@query(
    "agg04_daily_kpi_exact",
    f"SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS txns, {decimal_sum_sql(thousandths_sql('value', 'event_id'))} AS total_amount FROM events GROUP BY 1, 2",
)
def _(t):
    out = agg.daily_kpi(t.events.withColumn("amount", thousandths("value", "event_id")), "ts", ["event_type"], "amount", None)
    return out.select("dt", "event_type", "txns", F.round("total_amount", 3).alias("total_amount"))


_FINAL = f"CASE WHEN o_orderstatus = 'F' THEN {thousandths_sql('o_totalprice', 'o_orderkey')} ELSE 0 END"


@query(
    "agg05_conditional_sum_exact",
    f"SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS final_rows, {decimal_sum_sql(_FINAL)} AS final_amount FROM orders GROUP BY o_custkey",
)
def _(t):
    final = F.col("o_orderstatus") == "F"
    rows = t.orders.withColumn("amount", thousandths("o_totalprice", "o_orderkey"))
    return rows.groupBy("o_custkey").agg(
        agg.count_where(final).alias("final_rows"), F.round(agg.sum_where(final, "amount", None), 3).alias("final_amount")
    )


@query(
    "agg05_conditional_sum",
    "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS final_rows, "
    f"CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {units_sql('o_totalprice')} ELSE 0 END) AS DOUBLE) / 100 AS final_amount FROM orders GROUP BY o_custkey",
)
def _(t):
    final = F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_custkey").agg(
        agg.count_where(final).alias("final_rows"), agg.sum_where(final, "o_totalprice").alias("final_amount")
    )


@query(
    "agg06_having",
    f"SELECT o_custkey, {sum_sql('o_totalprice')} AS total FROM orders GROUP BY o_custkey HAVING {sum_sql('o_totalprice')} > 2500000",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total")).filter(F.col("total") > 2500000)


LEVELS = f"SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount FROM orders GROUP BY "
KEYS = ["o_orderstatus", "o_orderpriority"]


@query("agg07_rollup", LEVELS + "ROLLUP (o_orderstatus, o_orderpriority)")
def _(t):
    return agg.rollup_kpi(t.orders, KEYS, "o_totalprice")


@query("agg08_cube", LEVELS + "CUBE (o_orderstatus, o_orderpriority)")
def _(t):
    return agg.cube_kpi(t.orders, KEYS, "o_totalprice")


@query("agg09_grouping_sets", LEVELS + "GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def _(t):
    return agg.grouping_sets_kpi(t.orders, [["o_orderstatus"], ["o_orderpriority"], []], KEYS, "o_totalprice")


GENERAL = {"n": ("count", "*"), "quantity": ("sum", "q"), "least": ("min", "l_extendedprice"), "most": ("max", "l_extendedprice"), "mean": ("avg", "q")}
GENERAL_SQL = (
    "count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, min(l_extendedprice) AS least, max(l_extendedprice) AS most, "
    "avg(CAST(l_quantity AS BIGINT)) AS mean"
)
LINE_KEYS = ["l_returnflag", "l_linestatus"]


def lines(t):
    return t.lineitem.withColumn("q", F.col("l_quantity").cast("long"))


def _levels_sql(sets: str) -> str:
    return f"SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level, {GENERAL_SQL} FROM lineitem GROUP BY {sets}"


@query("agg07_rollup_any", _levels_sql("ROLLUP (l_returnflag, l_linestatus)"))
def _(t):
    return agg.levels_agg(lines(t), LINE_KEYS, GENERAL)


@query("agg08_cube_any", _levels_sql("CUBE (l_returnflag, l_linestatus)"))
def _(t):
    return agg.levels_agg(lines(t), LINE_KEYS, GENERAL, "cube")


@query("agg09_grouping_sets_any", _levels_sql("GROUPING SETS ((l_returnflag), (l_linestatus), ())"))
def _(t):
    return agg.levels_agg(lines(t), LINE_KEYS, GENERAL, [["l_returnflag"], ["l_linestatus"], []])


@query("agg15_salted_any", f"SELECT l_returnflag, {GENERAL_SQL} FROM lineitem GROUP BY l_returnflag")
def _(t):
    """Three keys, each with a third of the rows."""
    return skew.salted_agg(lines(t), ["l_returnflag"], GENERAL, ["l_orderkey", "l_linenumber"])


# Amounts of three decimals, summed by DuckDB's decimals.
THIN_SQL = "CAST(sum(CAST(round(l_quantity * 1.125, 3) AS DECIMAL(18, 3))) AS DOUBLE)"


@query(
    "agg07_rollup_thousandths",
    f"SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS txns, {THIN_SQL} AS total_amount "
    "FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
)
def _(t):
    return agg.rollup_kpi(t.lineitem.withColumn("a", F.col("l_quantity") * 1.125), LINE_KEYS, "a", scale=3)


@query("agg15_salted_thousandths", f"SELECT l_returnflag, count(*) AS n_rows, {THIN_SQL} AS total FROM lineitem GROUP BY l_returnflag")
def _(t):
    rows = t.lineitem.withColumn("a", F.col("l_quantity") * 1.125)
    return skew.salted_totals(rows, ["l_returnflag"], "a", ["l_orderkey", "l_linenumber"], scale=3).drop("average")


@query(
    "agg10_pivot",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(sum({units_sql('value')}) FILTER (WHERE event_type = '{v}') AS DOUBLE) / 100 AS {v}" for v in ("click", "view", "purchase")
    )
    + " FROM events GROUP BY user_id",
)
def _(t):
    return agg.pivot_sum(t.events, ["user_id"], "event_type", ["click", "view", "purchase"], "value")


@query(
    "agg11_unpivot",
    "SELECT l_orderkey, l_linenumber, 'l_discount' AS measure, l_discount AS amount FROM lineitem UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', l_quantity FROM lineitem",
)
def _(t):
    return agg.unpivot(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax", "l_quantity"], "measure", "amount")


@query(
    "agg12_list_text",
    f"""SELECT custkey, (rn - 1) // 1000 AS part, count(*) AS n_items, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rn) AS items
        FROM (SELECT {HOT_SQL} AS custkey, o_orderkey, row_number() OVER (PARTITION BY {HOT_SQL} ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
        GROUP BY 1, 2""",
)
def _(t):
    """Ordered list per customer in parts of a thousand; the hot customer has several."""
    return agg.list_text(hot_orders(t), ["custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"], part_size=1000)


@query(
    "agg13_collect_list_and_set",
    """WITH s AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS rn FROM (SELECT DISTINCT user_id, event_type FROM events)),
       l AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       SELECT user_id, 'set' AS kind, (rn - 1) // 1000 AS part, count(*) AS n_items, string_agg(event_type, ',' ORDER BY rn) AS items FROM s GROUP BY 1, 3
       UNION ALL SELECT user_id, 'list', (rn - 1) // 1000, count(*), string_agg(event_type, ',' ORDER BY rn) FROM l GROUP BY 1, 3""",
)
def _(t):
    events = t.events.select("user_id", "event_type", "ts", "event_id")
    as_set = agg.list_parts(events, ["user_id"], "event_type", ["event_type"], 1000, distinct=True)
    as_list = agg.list_parts(events, ["user_id"], "event_type", ["ts", "event_id"], 1000)
    both = as_set.withColumn("kind", F.lit("set")).unionByName(as_list.withColumn("kind", F.lit("list")))
    return both.withColumn("items", F.array_join("items", ","))


@query("agg14_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query("agg15_salted_totals", TOTALS)
def _(t):
    return skew.salted_totals(hot_orders(t), ["custkey"], "o_totalprice", ["o_orderkey"])


@query("agg16_hot_key_salted_totals", TOTALS)
def _(t):
    rows = hot_orders(t)
    return skew.salted_totals(rows, ["custkey"], "o_totalprice", ["o_orderkey"], hot=skew.hot_keys(rows, "custkey"))


@query(
    "agg17_skew_profile",
    f"""SELECT custkey, n_rows, CAST(n_rows AS DOUBLE) / (SELECT count(*) FROM orders) AS share, n_rows > 0.05 * (SELECT count(*) FROM orders) AS is_hot
        FROM (SELECT {HOT_SQL} AS custkey, count(*) AS n_rows FROM orders GROUP BY 1) ORDER BY n_rows DESC, custkey LIMIT 20""",
)
def _(t):
    return skew.skew_profile(hot_orders(t), "custkey", 20)


@query(
    "agg18_layered",
    f"""SELECT o_custkey, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount, min(o_totalprice) AS min_amount,
        max(o_totalprice) AS max_amount, {avg_sql('o_totalprice')} AS avg_amount FROM orders GROUP BY o_custkey""",
)
def _(t):
    """Customer and day written as a table, then customer from that table."""
    path = t.scratch("daily")
    agg.daily_parts(t.orders, "o_orderdate", ["o_custkey"], "o_totalprice").write.parquet(path)
    return agg.from_daily(t.spark.read.parquet(path), ["o_custkey"])


@query(
    "agg19_totals_by_attribute",
    f"SELECT c_mktsegment, count(DISTINCT o_custkey) AS n_customers, {sum_sql('o_totalprice')} AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
)
def _(t):
    per = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total"))
    side = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = join_as(per, side, "o_custkey", "inner", "broadcast")
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"), exact_sum("total").alias("total"))


@query(
    "agg20_one_exchange",
    f"""SELECT o_custkey, count(*) AS active_days, max(d) AS best_day, {sum_sql('d')} AS total FROM
        (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dt, {sum_sql('o_totalprice')} AS d FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    """Two aggregates on the same key after one exchange."""
    laid = agg.one_exchange(t.orders.select("o_custkey", F.to_date("o_orderdate").alias("dt"), "o_totalprice"), "o_custkey")
    daily = laid.groupBy("o_custkey", "dt").agg(exact_sum("o_totalprice").alias("d"))
    return daily.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("active_days"), F.max("d").alias("best_day"), exact_sum("d").alias("total")
    )


def _profile_sql(table: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        at = ", ".join(
            f"a[CAST(floor({p} * (n - 1)) AS BIGINT) + 1] + (a[CAST(ceil({p} * (n - 1)) AS BIGINT) + 1] - a[CAST(floor({p} * (n - 1)) AS BIGINT) + 1])"
            f" * ({p} * (n - 1) - floor({p} * (n - 1))) AS p{int(p * 100)}"
            for p in (0.25, 0.5, 0.75)
        )
        return (
            f"SELECT '{c}' AS column_name, n, n_null, mean, stddev, \"min\", \"max\", {at} FROM (SELECT count({c}) AS n, count(*) - count({c}) AS n_null, "
            f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\", list_sort(list(CAST({c} AS DOUBLE))) AS a FROM {table})"
        )

    return " UNION ALL ".join(one(c) for c in columns).replace("0.25 *", "CAST(0.25 AS DOUBLE) *").replace("0.5 *", "CAST(0.5 AS DOUBLE) *").replace("0.75 *", "CAST(0.75 AS DOUBLE) *")


@query("agg21_numeric_profile", _profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def _(t):
    profile = agg.numeric_profile(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return profile.withColumn("mean", F.round("mean", 6))


@query("agg22_value_frequencies", "SELECT l_quantity, count(*) AS n_rows FROM lineitem GROUP BY l_quantity")
def _(t):
    return agg.frequencies(t.lineitem, "l_quantity")


@query("agg23_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"))
