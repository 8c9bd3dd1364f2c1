"""Set operations (SET)."""

from pyspark.sql import functions as F

from lakeops.operators import sets
from lakeops.queries.registry import query

EARLY = "(SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')"
LATE = "(SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"


def early_late(t):
    start = F.lit("1997-01-01").cast("timestamp_ntz")
    rows = t.orders
    keys = ["o_custkey", "o_orderstatus"]
    return rows.filter(F.col("o_orderdate") < start).select(*keys), rows.filter(F.col("o_orderdate") >= start).select(*keys)


@query("set01_union_all", f"SELECT * FROM {EARLY} UNION ALL SELECT * FROM {LATE}")
def _(t):
    return sets.union_all(*early_late(t))


@query("set02_union_by_name", f"SELECT o_custkey, o_orderstatus FROM {EARLY} UNION ALL BY NAME SELECT o_orderstatus, o_custkey FROM {LATE}")
def _(t):
    a, b = early_late(t)
    return sets.union_by_name(a, b.select("o_orderstatus", "o_custkey"))


@query(
    "set03_union_fill_missing",
    f"SELECT o_custkey, o_orderstatus, NULL::VARCHAR AS note FROM {EARLY} UNION ALL SELECT o_custkey, o_orderstatus, 'late' FROM {LATE}",
)
def _(t):
    a, b = early_late(t)
    return sets.union_by_name(a, b.withColumn("note", F.lit("late")), fill_missing=True)


@query(
    "set04_union_distinct",
    "SELECT event_id, user_id, event_type FROM events UNION SELECT event_id, user_id, event_type FROM events WHERE event_id % 5 = 0",
)
def _(t):
    """Events and a second sending of every fifth."""
    rows = t.events.select("event_id", "user_id", "event_type")
    return sets.union_distinct(rows, rows.filter("event_id % 5 = 0"))


@query("set05_except_all", f"SELECT * FROM {EARLY} EXCEPT ALL SELECT * FROM {LATE}")
def _(t):
    return sets.except_all(*early_late(t))


@query("set06_minus", f"SELECT * FROM {EARLY} EXCEPT SELECT * FROM {LATE}")
def _(t):
    return sets.minus(*early_late(t))


@query("set08_intersect", f"SELECT * FROM {EARLY} INTERSECT SELECT * FROM {LATE}")
def _(t):
    return sets.intersect(*early_late(t))
