"""Incremental batch and MERGE (INC)."""

from pyspark.sql import functions as F

from lakeops.operators.layout import overwrite_partitions
from lakeops.operators.merge import Keyed, merge_columns, merge_partitions
from lakeops.queries.registry import MONTH_SQL, Tables, by_month, query

BASE_SQL = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 1 AS ingest_rank, {MONTH_SQL} AS month FROM orders"
UPDATED_SQL = (
    f"SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, floor(o_totalprice * 105.0 + 0.5) / 100.0 AS o_totalprice, o_orderdate, 2 AS ingest_rank, {MONTH_SQL} AS month "
    "FROM orders WHERE o_orderkey % 10 = 0"
)
NEW_SQL = f"SELECT -1 - o_orderkey AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 2 AS ingest_rank, {MONTH_SQL} AS month FROM orders WHERE o_orderkey % 50 = 0"
LATE_SQL = f"{UPDATED_SQL} UNION ALL {NEW_SQL}"
MERGED_SQL = f"SELECT * FROM ({BASE_SQL} UNION ALL {LATE_SQL}) QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, ingest_rank DESC) = 1"


def base(t: Tables):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return by_month(t.orders.select(*cols, F.lit(1).alias("ingest_rank")))


def late_batch(t: Tables):
    """Corrections (price raised, status final, same date, later arrival) and new rows for old dates."""
    rows = base(t).withColumn("ingest_rank", F.lit(2))
    raised = F.floor(F.col("o_totalprice") * 105.0 + 0.5) / 100.0
    updates = rows.filter("o_orderkey % 10 = 0").withColumns({"o_totalprice": raised, "o_orderstatus": F.lit("F")})
    fresh = rows.filter("o_orderkey % 50 = 0").withColumn("o_orderkey", F.lit(-1) - F.col("o_orderkey"))
    return updates.unionByName(fresh)


def silver_orders(t: Tables, name: str = "orders-silver", indexed: bool = False) -> Keyed:
    index = t.scratch(f"{name}-index") if indexed else None
    table = Keyed(t.scratch(name), ["o_orderkey"], ["o_orderdate", "ingest_rank"], ["month"], index)
    overwrite_partitions(base(t), table.path, table.part_cols)
    return table


@query("inc01_late_data_merge", MERGED_SQL)
def _(t):
    table = silver_orders(t)
    merge_partitions(t.spark, table, late_batch(t), key_stays_in_partition=True)
    return t.spark.read.parquet(table.path).select(*base(t).columns)


MOVED_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 31 DAY AS o_orderdate, 3 AS ingest_rank, "
    "CAST(date_trunc('month', o_orderdate + INTERVAL 31 DAY) AS DATE) AS month FROM orders WHERE o_orderkey % 25 = 1"
)


def _moving(t: Tables, indexed: bool):
    table = silver_orders(t, indexed=indexed)
    moved = by_month(
        base(t).filter("o_orderkey % 25 = 1").withColumns(
            {"o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 31 DAYS"), "ingest_rank": F.lit(3)}
        )
    )
    for _ in range(2):
        merge_partitions(t.spark, table, late_batch(t).unionByName(moved))
    return t.spark.read.parquet(table.path).select(*base(t).columns)


_MOVING_SQL = (
    f"SELECT * FROM ({BASE_SQL} UNION ALL {LATE_SQL} UNION ALL {MOVED_SQL}) "
    "QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, ingest_rank DESC) = 1"
)


@query("inc02_merge", _MOVING_SQL)
def _(t):
    """Matched rows updated, others inserted; keys that move to the next month leave their old one. Run twice."""
    return _moving(t, False)


@query("inc02_indexed_merge", _MOVING_SQL)
def _(t):
    """The same by an index of the keys, made from the table as it is and kept by the merges."""
    return _moving(t, True)


@query(
    "inc02_merge_columns",
    "SELECT c.c_custkey, coalesce(n.c_mktsegment, c.c_mktsegment) AS c_mktsegment, coalesce(n.c_acctbal, c.c_acctbal) AS c_acctbal FROM customer c "
    "LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' END AS c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 END AS c_acctbal "
    "FROM customer WHERE c_custkey % 5 <> 0) n USING (c_custkey) UNION ALL SELECT -1 - c_custkey, c_mktsegment, NULL FROM customer WHERE c_custkey % 9 = 0",
)
def _(t):
    """Column by column: what the change leaves null keeps its old value."""
    k = F.col("c_custkey")
    old = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    change = old.filter(k % 5 != 0).select(
        "c_custkey", F.when(k % 3 == 0, "MOVED").alias("c_mktsegment"), F.when(k % 2 == 0, F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    added = old.filter(k % 9 == 0).select((-1 - k).alias("c_custkey"), "c_mktsegment", F.lit(None).cast("double").alias("c_acctbal"))
    return merge_columns(old, change.unionByName(added), ["c_custkey"], ["c_mktsegment", "c_acctbal"])


@query("inc03_late_batch", LATE_SQL)
def _(t):
    return late_batch(t)


def _parted(kind: str) -> str:
    return "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')" if kind == "text" else "o_orderkey % 3 = 0"


def _part(kind: str):
    return F.lpad(F.month("o_orderdate").cast("string"), 2, "0") if kind == "text" else F.col("o_orderkey") % 3 == 0


def _typed_merge(kind: str, stays: bool):
    """The late batch into a table by a zero-padded month or by a flag: its values keep their type."""

    def run(t: Tables):
        rows = base(t).withColumn("month", _part(kind))
        table = Keyed(t.scratch(f"orders-{kind}"), ["o_orderkey"], ["o_orderdate", "ingest_rank"], ["month"])
        overwrite_partitions(rows, table.path, table.part_cols)
        late = late_batch(t).withColumn("month", _part(kind))
        merge_partitions(t.spark, table, late, key_stays_in_partition=stays)
        return table.read(t.spark, rows.schema).select(*rows.columns)

    return run


for _kind in ("text", "flag"):
    _sql = f"SELECT * REPLACE ({_parted(_kind)} AS month) FROM ({MERGED_SQL})"
    query(f"inc01_late_data_by_{_kind}", _sql)(_typed_merge(_kind, True))
    query(f"inc02_merge_by_{_kind}", _sql)(_typed_merge(_kind, False))


@query(
    "inc02_merge_added_column",
    "SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 2 WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment, "
    "CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 = 0 THEN 'checked' END AS note FROM customer",
)
def _(t):
    """A batch brings a column, the next one lacks it: the column and its values stay."""
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", F.lit(1).alias("seq"))
    table = Keyed(t.scratch("customers"), ["c_custkey"], ["seq"], ["c_mktsegment"])
    overwrite_partitions(rows, table.path, table.part_cols)

    def batch(by: int, seq: int):
        return rows.filter(F.col("c_custkey") % by == 0).withColumns({"c_acctbal": F.col("c_acctbal") + (seq - 1), "seq": F.lit(seq)})

    merge_partitions(t.spark, table, batch(3, 2).withColumn("note", F.lit("checked")))
    merge_partitions(t.spark, table, batch(5, 3))
    return table.read(t.spark, rows.schema).select("c_custkey", "c_acctbal", "c_mktsegment", "note")
