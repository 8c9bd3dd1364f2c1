"""Joins under every strategy (JON)."""

from pyspark.sql import functions as F

from lakeops.functions.money import exact_sum
from lakeops.operators import skew
from lakeops.operators.aggregate import kpi
from lakeops.operators.hierarchy import forest, walk
from lakeops.operators.joins import Dim, bucketed_join, exists_in, fan_out, join_as, not_exists_in, prefixed, star_join
from lakeops.operators.layout import buckets_for, write_bucketed
from lakeops.queries.registry import HOT_SQL, Tables, avg_sql, hot_orders, query, sum_sql
from lakeops.session import skew_session

BY_SEGMENT = (
    f"SELECT c_mktsegment, count(*) AS txns, {sum_sql('o_totalprice')} AS total_amount, {avg_sql('o_totalprice')} AS avg_amount "
    "FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"
)
HOT_JOIN = f"SELECT o_orderkey, {HOT_SQL} AS custkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON {HOT_SQL} = c_custkey"


def segments(t: Tables, key: str = "o_custkey"):
    return t.customer.select(F.col("c_custkey").alias(key), "c_mktsegment")


def by_segment(t: Tables, strategy: str):
    joined = join_as(t.orders.select("o_custkey", "o_totalprice"), segments(t), "o_custkey", "left", strategy)
    return kpi(joined, ["c_mktsegment"], "o_totalprice")


def hot(t: Tables):
    return hot_orders(t).select("o_orderkey", "custkey", "o_totalprice")


@query("jon01_inner_using", "SELECT o_custkey, o_orderkey, c_mktsegment FROM orders JOIN (SELECT c_custkey AS o_custkey, c_mktsegment FROM customer) USING (o_custkey)")
def _(t):
    return t.orders.select("o_custkey", "o_orderkey").join(segments(t), "o_custkey")


@query(
    "jon02_left_using",
    "SELECT o_custkey, o_orderkey, c_mktsegment FROM orders LEFT JOIN (SELECT c_custkey AS o_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0) USING (o_custkey)",
)
def _(t):
    side = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.select("o_custkey", "o_orderkey").join(side, "o_custkey", "left")


@query("jon03_left_other_names", "SELECT o_orderkey, o_custkey, c_custkey AS c_c_custkey, c_name AS c_c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    side = prefixed(t.customer, "c_", ["c_custkey", "c_name"])
    o = t.orders.select("o_orderkey", "o_custkey")
    return join_as(o, side, F.col("o_custkey") == F.col("c_c_custkey"), "left")


@query("jon04_broadcast", BY_SEGMENT)
def _(t):
    return by_segment(t, "broadcast")


@query("jon05_broadcast_sql_hint", BY_SEGMENT)
def _(t):
    """The hint in SQL text; the dimension's size is checked before it is written."""
    from lakeops.operators.joins import BROADCAST_LIMIT, measured_bytes

    dim = segments(t)
    hint = "/*+ BROADCAST(d) */" if measured_bytes(dim) <= BROADCAST_LIMIT else ""
    joined = t.spark.sql(
        f"SELECT {hint} d.c_mktsegment, o.o_totalprice FROM {{o}} o LEFT JOIN {{d}} d ON o.o_custkey = d.o_custkey",
        o=t.orders,
        d=dim,
    )
    return kpi(joined, ["c_mktsegment"], "o_totalprice")


@query("jon06_size_threshold", BY_SEGMENT)
def _(t):
    return by_segment(t, "auto")


@query("jon07_sort_merge", BY_SEGMENT)
def _(t):
    return by_segment(t, "merge")


@query("jon08_shuffled_hash", BY_SEGMENT)
def _(t):
    return by_segment(t, "shuffle_hash")


@query("jon09_fan_out", "SELECT c_custkey, c_mktsegment FROM customer, range(5)")
def _(t):
    """A dimension five times over, made in place instead of by a cross join."""
    return fan_out(t.customer.select("c_custkey", "c_mktsegment"), 5)


@query("jon10_bucketed", "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    a, b = t.scratch("bucket-o"), t.scratch("bucket-c")
    n = buckets_for(t.orders)
    left = write_bucketed(t.orders.select("o_orderkey", "o_custkey"), "jon10o_" + a[-32:], ["o_custkey"], n, a)
    right = write_bucketed(segments(t), "jon10c_" + b[-32:], ["o_custkey"], n, b)
    return bucketed_join(t.spark, left, right, "o_custkey", n)


@query(
    "jon11_star",
    "SELECT l_orderkey, l_linenumber, s_name AS m_s_name, p_brand, n.n_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey "
    "LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN nation n ON s_nationkey = n.n_nationkey",
)
def _(t):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    dims = [
        Dim(t.supplier, "l_suppkey", "s_suppkey", ["s_name", "s_nationkey"], "m_"),
        Dim(t.part, "l_partkey", "p_partkey", ["p_brand"]),
        Dim(t.nation, "m_s_nationkey", "n_nationkey", ["n_name"]),
    ]
    return star_join(fact, dims).select("l_orderkey", "l_linenumber", "m_s_name", "p_brand", "n_name")


@query(
    "jon12_prune_then_join",
    "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey "
    "WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'",
)
def _(t):
    from lakeops.sources.tables import day_range

    slim = day_range(t.orders, "o_orderdate", "1997-01-01", "1997-02-01").select("o_orderkey", "o_custkey")
    return join_as(slim, segments(t), "o_custkey", "left", "broadcast").drop("o_custkey")


@query(
    "jon13_aggregate_then_join",
    f"SELECT o_custkey, CAST(o_orderdate AS DATE) AS dt, {sum_sql('o_totalprice')} AS total, c_mktsegment "
    "FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, dt, c_mktsegment",
)
def _(t):
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("dt")).agg(exact_sum("o_totalprice").alias("total"))
    return join_as(daily, segments(t), "o_custkey", "left", "broadcast")


@query(
    "jon14_semi",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)",
)
def _(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return exists_in(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query(
    "jon15_anti",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)",
)
def _(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return not_exists_in(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query("jon16_salted", HOT_JOIN)
def _(t):
    return skew.salted_join(hot(t), segments(t, "custkey"), "custkey", ["o_orderkey"])


@query("jon17_concat_salted", HOT_JOIN)
def _(t):
    return skew.concat_salted_join(hot(t), segments(t, "custkey"), "custkey", ["o_orderkey"])


@query("jon18_partial_salted", HOT_JOIN)
def _(t):
    """The hot keys are given: the customer that holds the derived quarter of the orders."""
    known = t.spark.createDataFrame([(1,)], "custkey long")
    return skew.partial_salted_join(hot(t), segments(t, "custkey"), "custkey", ["o_orderkey"], known)


@query("jon19_hot_keys_found", HOT_JOIN)
def _(t):
    return skew.partial_salted_join(hot(t), segments(t, "custkey"), "custkey", ["o_orderkey"], share=0.05)


@query("jon20_adaptive_skew_join", HOT_JOIN)
def _(t):
    """Sort-merge join in a session where adaptive execution splits the skewed partitions."""
    tuned = Tables(skew_session(t.spark), t.directory)
    return join_as(hot(tuned), segments(tuned, "custkey"), "custkey", "left", "merge")


@query(
    "jon21_hierarchy",
    """WITH RECURSIVE e AS (SELECT c_custkey AS id, c_custkey // 2 AS parent_id FROM customer WHERE c_custkey > 0),
       w AS (SELECT CAST(0 AS BIGINT) AS root, CAST(0 AS BIGINT) AS node, CAST(1 AS BIGINT) AS level, '0' AS path
             UNION ALL SELECT root, id, level + 1, path || '/' || CAST(id AS VARCHAR) FROM w JOIN e ON parent_id = node)
       SELECT * FROM w""",
)
def _(t):
    """Every customer below customer 0, the parent of n being n / 2. Customer 0 is its own parent: a cycle."""
    edges = t.customer.select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 2).alias("parent_id"))
    return walk(edges, t.customer.filter("c_custkey = 0").select("c_custkey"))


@query(
    "jon21_hierarchy_recursive_sql",
    """WITH RECURSIVE e AS (SELECT n_name AS id, r_name AS parent_id FROM nation JOIN region ON n_regionkey = r_regionkey
         UNION ALL SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
       w AS (SELECT r_name AS node, 1 AS level FROM region UNION ALL SELECT id, level + 1 FROM w JOIN e ON parent_id = node)
       SELECT level, count(*) AS n_nodes FROM w GROUP BY level""",
)
def _(t):
    """Region, nation, customer, level by level."""
    region, nation = t.region, t.nation
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    edges = named.select(F.col("n_name").alias("id"), F.col("r_name").alias("parent_id")).unionAll(
        t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_name", "n_name")
    )
    found = walk(edges, region.select("r_name"))
    return found.groupBy(F.col("level").cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n_nodes"))


@query(
    "jon21_forest",
    """WITH o AS (SELECT o_orderkey AS node, CASE WHEN min(o_orderkey) OVER (PARTITION BY o_orderkey % 4) = o_orderkey THEN NULL ELSE o_orderkey - 4 END AS parent_id FROM orders)
       SELECT node, CASE WHEN node % 4 <> 3 THEN first_value(node) OVER w END AS root, CASE WHEN node % 4 <> 3 THEN row_number() OVER w END AS level
       FROM o WINDOW w AS (PARTITION BY node % 4 ORDER BY node)""",
)
def _(t):
    """Four chains through all orders, each a quarter of them deep; one ends in a cycle."""
    k = F.col("o_orderkey")
    first = t.orders.agg(F.min("o_orderkey")).first()[0]
    up = F.when(k - 4 >= first, k - 4).when(k % 4 == 3, k + 4)
    return forest(t.orders.select(k.alias("id"), up.alias("parent_id")), paths=False)


@query(
    "jon21_forest_paths",
    """SELECT c_custkey AS node, CAST(0 AS BIGINT) AS root, len(up) + 1 AS level, '0' || array_to_string(['/' || CAST(x AS VARCHAR) for x in list_reverse(up)], '') AS path
       FROM (SELECT c_custkey, [c_custkey >> i for i in range(40) if c_custkey >> i > 0] AS up FROM customer)""",
)
def _(t):
    """The customers of `jon21_hierarchy`, with their paths, by doubling."""
    return forest(t.customer.select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 2).alias("parent_id")))
