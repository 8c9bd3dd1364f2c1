"""Gold from changes against Gold rebuilt from Silver."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators.merge import SIGN, Keyed
from lakeops.streaming import gold as module
from lakeops.streaming.gold import ChangeGold
from lakeops.streaming.silver import Upsert
from tests.conftest import rows

SCHEMA = "id long, seq int, op string, dt string, kind string, amount double"
# Inserts, a key that moves, least and greatest amounts that leave, null groups and amounts, a group that loses all rows, one that comes back.
BATCHES = [
    [(i, 1, "I", f"2024-01-0{i % 3 + 1}", "ab"[i % 2], i / 4) for i in range(1, 25)] + [(30, 1, "I", "2024-01-01", None, 5.0), (31, 1, "I", "2024-01-02", None, None)],
    [(1, 2, "U", "2024-01-03", "a", 9.25), (24, 2, "U", "2024-01-01", "a", 0.5), (30, 2, "D", "2024-01-01", None, 5.0), (31, 2, "U", "2024-01-02", None, 2.5)],
    [(31, 3, "D", "2024-01-02", None, None), (30, 3, "I", "2024-01-09", "c", -1.5), (3, 1, "U", "2024-01-01", "b", 77.0), (2, 0, "U", "2024-01-01", "b", 99.0)],
    [(30, 4, "D", "2024-01-09", "c", None), (5, 4, "U", "2024-01-03", "b", None), (40, 1, "I", "2024-01-02", None, 8.0)],
]


def rebuilt(spark, table):
    silver = spark.read.parquet(table.path).withColumn("dt", F.col("dt").cast("string"))
    return rows(
        silver.groupBy("dt", "kind").agg(
            F.count(F.lit(1)), F.round(F.sum("amount"), 2), F.sum("amount") / F.count("amount"), F.min("amount"), F.max("amount")
        )
    )


def current(spark, gold):
    return rows(gold.read(spark).withColumn("dt", F.col("dt").cast("string")))


def sink(folder, indexed):
    table = Keyed(folder("silver"), ["id"], ["seq"], ["dt"], folder("index") if indexed else None)
    gold = ChangeGold(folder("gold"), ["dt", "kind"], ["dt"], "amount")
    return Upsert(table, {"id": F.col("id").isNotNull()}, deleted=F.col("op") == "D", change_gold=gold)


@pytest.mark.parametrize("indexed", [False, True])
def test_equals_a_rebuild_after_every_batch(spark, folder, indexed):
    up = sink(folder, indexed)
    for batch_id, batch in enumerate(BATCHES):
        frame = spark.createDataFrame(batch, SCHEMA)
        up(frame, batch_id)
        assert current(spark, up.change_gold) == rebuilt(spark, up.table)
        if batch_id % 2:
            up(frame, batch_id)
            assert current(spark, up.change_gold) == rebuilt(spark, up.table)


def test_crash_before_and_amid_gold(spark, folder, monkeypatch):
    up = sink(folder, False)
    up(spark.createDataFrame(BATCHES[0], SCHEMA), 0)
    frame, real = spark.createDataFrame(BATCHES[1], SCHEMA), module.overwrite_partitions

    def half(df, path, part_cols):
        real(df.filter("dt = '2024-01-01'"), path, part_cols)
        raise RuntimeError("lost")

    def none(*_):
        raise RuntimeError("lost")

    for broken in (none, half):
        monkeypatch.setattr(module, "overwrite_partitions", broken)
        with pytest.raises(RuntimeError, match="lost"):
            up(frame, 1)
    monkeypatch.setattr(module, "overwrite_partitions", real)
    up(frame, 1)
    assert current(spark, up.change_gold) == rebuilt(spark, up.table)


def test_gold_that_starts_later(spark, folder):
    up = sink(folder, False)
    without = Upsert(up.table, up.rules, deleted=up.deleted)
    without(spark.createDataFrame(BATCHES[0], SCHEMA), 0)
    up(spark.createDataFrame(BATCHES[1], SCHEMA), 1)
    assert current(spark, up.change_gold) == rebuilt(spark, up.table)


def test_silver_is_read_only_where_an_extreme_left(spark, folder):
    gold = ChangeGold(folder("gold"), ["dt", "kind"], ["dt"], "amount")
    asked = []

    def silver():
        asked.append(1)
        return spark.createDataFrame([("d", "a", 2.0), ("d", "a", 4.0), ("d", "b", 100.0), ("e", "a", 100.0)], "dt string, kind string, amount double")

    def add(batch_id, *changes):
        gold.keep(spark.createDataFrame(changes, f"{SIGN} int, dt string, kind string, amount double"), batch_id)
        gold.apply(spark, batch_id, silver)
        return [tuple(r) for r in gold.read(spark).filter("kind = 'a'").select("txns", "total_amount", "min_amount", "max_amount").collect()]

    assert add(0, *[(1, "d", "a", x) for x in (1.0, 2.0, 3.0, 4.0)]) == [(4, 10.0, 1.0, 4.0)]
    # One from the middle, the least one for a lesser one, the greatest one that stays.
    assert add(1, (-1, "d", "a", 3.0)) == [(3, 7.0, 1.0, 4.0)]
    assert add(2, (-1, "d", "a", 1.0), (1, "d", "a", 0.5), (-1, "d", "a", 4.0), (1, "d", "a", 4.0)) == [(3, 6.5, 0.5, 4.0)]
    assert asked == []
    assert add(3, (-1, "d", "a", 0.5)) == [(2, 6.0, 2.0, 4.0)] and asked == [1]
    with pytest.raises(Exception, match="not the Gold of this Silver"):
        add(4, *[(-1, "d", "a", 2.0)] * 3)
