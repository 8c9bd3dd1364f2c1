"""Merges by a key index: what is read, moved keys, tombstones, crashes, compaction."""

import glob
from datetime import datetime, timedelta, timezone
from unittest import mock

import pytest
from pyspark.sql import functions as F

from lakeops.operators import merge
from lakeops.operators.key_index import BUCKET, GONE, KeyIndex
from lakeops.operators.merge import Keyed, merge_partitions
from tests.conftest import plan

SCHEMA = "id long, v string, seq int, op string, dt string"
BASE = [(1, "a", 1, "I", "d1"), (2, "b", 1, "I", "d1"), (3, "c", 1, "I", "d2"), (4, "d", 1, "I", "03")]


@pytest.fixture
def table(spark, folder):
    t = Keyed(folder("silver"), ["id"], ["seq"], ["dt"], folder("index"), {"compact_after": 3})
    put(spark, t, *BASE)
    return t


def put(spark, table, *rows, **kw):
    return merge_partitions(spark, table, spark.createDataFrame(rows, SCHEMA), deleted=F.col("op") == "D", **kw)


def now(spark, table):
    found = table.read(spark, spark.createDataFrame([], SCHEMA).schema)
    return {r.id: (r.v, r.dt) for r in found.collect()} if found is not None else {}


def test_moves_updates_and_inserts(spark, table):
    put(spark, table, (1, "a2", 2, "U", "d2"), (5, "e", 1, "I", "d9"), (3, "old", 0, "U", "d2"))
    assert now(spark, table) == {1: ("a2", "d2"), 2: ("b", "d1"), 3: ("c", "d2"), 4: ("d", "03"), 5: ("e", "d9")}
    put(spark, table, (2, "b2", 2, "U", "d2"))
    assert now(spark, table)[2] == ("b2", "d2") and not glob.glob(f"{table.path}/dt=d1/*.parquet")


def test_only_the_buckets_and_partitions_of_the_keys_are_read(spark, table):
    index, state = table.index, table.index.state(spark)
    found = index.lookup(spark, state, spark.createDataFrame([(3,)], "id long"))
    assert "PartitionFilters: [isnotnull(__bucket" in plan(found) or f"{BUCKET}" in plan(found).split("PartitionFilters")[1][:60]
    assert [(r.id, r.dt) for r in found.collect()] == [(3, "d2")]
    # Files of other partitions may as well be unreadable: not even their footers are looked at.
    for path in glob.glob(f"{table.path}/dt=d1/*.parquet"):
        open(path, "wb").write(b"no parquet")
    put(spark, table, (3, "c2", 2, "U", "d3"), (9, "n", 1, "I", "d9"))
    read = spark.read.schema(state.schema).parquet(table.path).filter("dt <> 'd1'")
    assert {(r.id, r.v, r.dt) for r in read.collect()} == {(3, "c2", "d3"), (4, "d", "03"), (9, "n", "d9")}


def test_an_older_version_after_its_delete_stays_out(spark, table):
    put(spark, table, (1, None, 5, "D", "d1"))
    put(spark, table, (1, "late", 3, "U", "d1"), (2, "b2", 2, "U", "d1"))
    assert 1 not in now(spark, table) and now(spark, table)[2] == ("b2", "d1")
    put(spark, table, (1, "again", 4, "U", "d2"))
    put(spark, table, (7, "x", 1, "I", "d7"))
    assert 1 not in now(spark, table)
    put(spark, table, (1, "back", 6, "I", "d2"))
    assert now(spark, table)[1] == ("back", "d2")
    # A delete of a key that never was keeps its older versions out too.
    put(spark, table, (8, None, 9, "D", "d1"))
    put(spark, table, (8, "late", 2, "I", "d1"))
    assert 8 not in now(spark, table)


def test_tombstones_go_after_their_time(spark, folder):
    clock = [datetime(2026, 1, 1, tzinfo=timezone.utc)]
    options = {"compact_after": 1, "keep_deleted": timedelta(days=3), "now": lambda: clock[0]}
    t = Keyed(folder("silver"), ["id"], ["seq"], ["dt"], folder("index"), options)
    put(spark, t, *BASE)
    put(spark, t, (1, None, 5, "D", "d1"))
    clock[0] += timedelta(days=2)
    put(spark, t, (1, "late", 3, "U", "d1"))
    assert 1 not in now(spark, t)
    clock[0] += timedelta(days=2)
    put(spark, t, (2, "b2", 2, "U", "d1"))
    # A delete seen again in between counts from then on.
    state = t.index.state(spark)
    assert len(state.versions) == 1
    clock[0] += timedelta(days=9)
    put(spark, t, (3, "c2", 2, "U", "d2"))
    assert not t.index._read(spark, t.index.state(spark)).filter(GONE).count()
    put(spark, t, (1, "much later", 3, "U", "d1"))
    assert now(spark, t)[1] == ("much later", "d1")


@pytest.mark.parametrize("step", ["overwrite_partitions", "empty_partitions", "commit"])
def test_a_crash_anywhere_then_a_replay_or_another_batch(spark, table, step):
    batch = [(1, "a2", 2, "U", "d2"), (2, "b2", 2, "U", "d3"), (3, None, 2, "D", "d2"), (6, "f", 1, "I", "d1")]
    owner = KeyIndex if step == "commit" else merge
    with mock.patch.object(owner, step, side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        put(spark, table, *batch)
    # Another batch first, about the same keys and others.
    put(spark, table, (1, "a3", 3, "U", "d1"), (4, "d2", 2, "U", "d2"))
    put(spark, table, *batch)
    want = {1: ("a3", "d1"), 2: ("b2", "d3"), 4: ("d2", "d2"), 6: ("f", "d1")}
    assert now(spark, table) == want
    rows = table.read(spark, spark.createDataFrame([], SCHEMA).schema)
    assert rows.count() == len(want)
    for _ in range(3):
        put(spark, table, *batch)
    assert now(spark, table) == want and len(table.index.state(spark).versions) <= 3


def test_index_of_an_existing_table_and_built_again(spark, table, folder):
    from dataclasses import replace

    other = replace(table, indexed=folder("index"))
    put(spark, other, (1, "a2", 2, "U", "d2"))
    assert now(spark, other)[1] == ("a2", "d2")
    schema = table.read(spark, spark.createDataFrame([], SCHEMA).schema).schema
    table.index.build(spark, table.read(spark, schema), schema)
    put(spark, table, (1, "a3", 3, "U", "03"))
    assert now(spark, table) == {1: ("a3", "03"), 2: ("b", "d1"), 3: ("c", "d2"), 4: ("d", "03")}


def test_an_added_column_and_null_keys(spark, table):
    more = spark.createDataFrame([(1, "a2", 2, "U", "d1", 7), (None, "n", 1, "I", "d1", 8)], SCHEMA + ", note int")
    merge_partitions(spark, table, more)
    put(spark, table, (None, "n2", 2, "U", "d2"), (2, "b2", 2, "U", "d1"))
    found = table.read(spark, more.schema)
    assert {(r.id, r.v, r.note) for r in found.collect()} == {(1, "a2", 7), (None, "n2", None), (2, "b2", None), (3, "c", None), (4, "d", None)}
