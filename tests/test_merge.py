"""Latest-wins merge: ties, moved keys, deletes, replays, schema growth."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators.layout import read_if_any
from lakeops.operators.merge import Keyed, apply_changes, merge_columns, merge_partitions
from tests.conftest import plan, rows

SCHEMA = "id long, v string, event_ts string, ingest_ts int, dt string"


@pytest.fixture
def table(spark, folder):
    t = Keyed(folder("silver"), ["id"], ["event_ts", "ingest_ts"], ["dt"])
    base = [(1, "a", "2024-01-01", 1, "d1"), (2, "b", "2024-01-01", 1, "d1"), (3, "c", "2024-01-02", 1, "d2"), (4, "d", "2024-01-03", 1, "d3")]
    merge_partitions(spark, t, spark.createDataFrame(base, SCHEMA))
    return t


def merged(spark, table, changes, **kw):
    merge_partitions(spark, table, spark.createDataFrame(changes, SCHEMA), **kw)
    return {r["id"]: (r["v"], r["dt"]) for r in spark.read.parquet(table.path).collect()}


def test_first_write_and_missing_path(spark, table, folder):
    assert spark.read.parquet(table.path).count() == 4
    assert read_if_any(spark, folder()) is None


def test_correction_with_the_same_event_time_wins(spark, table):
    out = merged(spark, table, [(1, "new", "2024-01-01", 2, "d1"), (2, "tie", "2024-01-01", 1, "d1"), (3, "old", "2024-01-01", 9, "d2")])
    assert out == {1: ("new", "d1"), 2: ("tie", "d1"), 3: ("c", "d2"), 4: ("d", "d3")}


def test_a_null_ingest_time_loses(spark, table):
    assert merged(spark, table, [(1, "null", "2024-01-01", None, "d1")])[1] == ("a", "d1")


def test_moved_key_leaves_no_second_version(spark, table):
    out = merged(spark, table, [(4, "moved", "2024-01-09", 1, "d9")])
    assert out[4] == ("moved", "d9") and spark.read.parquet(table.path).count() == 4
    assert spark.read.parquet(table.path).filter("dt = 'd3'").count() == 0


def test_older_version_for_another_day_changes_nothing(spark, table):
    out = merged(spark, table, [(4, "late", "2024-01-01", 1, "d1")])
    assert out[4] == ("d", "d3") and len(out) == 4


def test_key_that_stays_reads_only_its_partitions(spark, table):
    out = merged(spark, table, [(1, "x", "2024-01-05", 1, "d1"), (9, "n", "2024-01-05", 1, "d2")], key_stays_in_partition=True)
    assert out[1] == ("x", "d1") and out[9] == ("n", "d2") and len(out) == 5


def test_delete_and_update_after_delete(spark, table):
    gone = F.col("v") == "D"
    out = merged(spark, table, [(4, "D", "2024-01-04", 1, "d3"), (3, "D", "2024-01-01", 1, "d2"), (7, "D", "2024-01-01", 1, "d7")], deleted=gone)
    assert 4 not in out and out[3] == ("c", "d2") and 7 not in out
    assert merged(spark, table, [(4, "back", "2024-01-05", 1, "d3")], deleted=gone)[4] == ("back", "d3")


def test_replay_and_many_versions_of_one_key(spark, table):
    changes = [(1, f"v{i:03}", f"2024-02-{i % 28 + 1:02}", i, f"d{i % 3}") for i in range(300)] + [(8, "n", "2024-01-01", 1, "d1")]
    first = merged(spark, table, changes)
    assert merged(spark, table, changes) == first
    assert first[1] == ("v279", "d0") and first[8] == ("n", "d1")


def test_null_key_is_one_key(spark, table):
    merged(spark, table, [(None, "x", "2024-01-01", 1, "d1")])
    out = merged(spark, table, [(None, "y", "2024-01-02", 1, "d2")])
    assert out[None] == ("y", "d2") and len(out) == 5


def test_new_column_is_added(spark, table):
    more = spark.createDataFrame([(1, "e", "2024-05-01", 1, "d1", 5)], SCHEMA + ", extra int")
    merge_partitions(spark, table, more)
    back = spark.read.option("mergeSchema", True).parquet(table.path)
    assert {r["id"]: r["extra"] for r in back.collect()} == {1: 5, 2: None, 3: None, 4: None}


def test_updates_reach_the_scan_as_partition_filter(spark, table):
    from lakeops.operators.layout import in_partitions

    assert "PartitionFilters: [dt" in plan(spark.read.parquet(table.path).filter(in_partitions([{"dt": "d1"}, {"dt": "d2"}])))


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = [(1, "x", "U", 1), (1, None, "D", 2), (2, None, "D", 1), (2, "y", "I", 2), (4, None, "D", 1), (4, "n", "I", 3), (5, "q", None, 1)]
    out = apply_changes(target, spark.createDataFrame(log, "id int, v string, op string, seq int"), ["id"], ["seq"])
    assert rows(out) == [(2, "y"), (3, "c"), (4, "n"), (5, "q")]


def test_merge_columns_keeps_old_values(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, s string, n int")
    new = spark.createDataFrame([(2, None, 9), (3, "z", None)], "id int, s string, n int")
    assert rows(merge_columns(old, new, ["id"], ["s", "n"])) == [(1, "a", 1), (2, "b", 9), (3, "z", None)]


PARTED = "id long, v double, seq int, mm string"


@pytest.mark.parametrize("stays", [True, False])
@pytest.mark.parametrize("kind", ["text", "boolean", "blanks", "timestamp"])
def test_partition_values_keep_their_type(spark, folder, kind, stays):
    a, b = {
        "text": ("01", "02"), "boolean": (True, False), "blanks": ("4-NOT SPECIFIED", "a:b/c%d"),
        "timestamp": (datetime(2026, 1, 1, 10, 30), datetime(2026, 1, 2)),
    }[kind]
    types = PARTED.replace("mm string", f"mm {'string' if kind == 'blanks' or kind == 'text' else kind}")
    frame = lambda rows: spark.createDataFrame(rows, types)
    t = Keyed(folder("parted"), ["id"], ["seq"], ["mm"])
    first = frame([(1, 1.0, 1, a), (2, 2.0, 1, a), (3, 3.0, 1, b)])
    merge_partitions(spark, t, first)
    merge_partitions(spark, t, frame([(2, 20.0, 2, a), (4, 4.0, 1, b)]), key_stays_in_partition=stays)
    got = t.read(spark, first.schema)
    assert got.schema["mm"].dataType == first.schema["mm"].dataType
    assert rows(got.select("id", "v", "mm")) == rows(frame([(1, 1.0, 0, a), (2, 20.0, 0, a), (3, 3.0, 0, b), (4, 4.0, 0, b)]).select("id", "v", "mm"))
    if not stays:
        # Both keys of b move to a: b goes, and no folder of another name appears.
        merge_partitions(spark, t, frame([(3, 30.0, 3, a), (4, 40.0, 3, a)]))
        got = t.read(spark, first.schema)
        assert rows(got.select("id", "mm")) == rows(frame([(i, 0.0, 0, a) for i in (1, 2, 3, 4)]).select("id", "mm"))
        assert len([d for d in os.listdir(t.path) if d.startswith("mm=")]) == 1


def test_columns_once_added_stay(spark, folder):
    t = Keyed(folder("grown"), ["id"], ["seq"], ["p"])
    plain = "id long, seq int, p string"
    merge_partitions(spark, t, spark.createDataFrame([(1, 1, "01"), (2, 1, "01"), (3, 1, "02")], plain))
    merge_partitions(spark, t, spark.createDataFrame([(2, 2, "01", "new")], plain + ", extra string"))
    merge_partitions(spark, t, spark.createDataFrame([(1, 3, "01"), (3, 2, "02")], plain))
    got = t.read(spark, spark.createDataFrame([], plain).schema)
    assert rows(got.select("id", "seq", "p", "extra")) == [(1, 3, "01", None), (2, 2, "01", "new"), (3, 2, "02", None)]


def test_many_updates_shuffle_whole_rows_once_with_the_same_result(spark, folder, monkeypatch):
    """Updates that are not broadcast: one join, of keys only, then one window; the table and the touched days are those of the other way."""
    from lakeops.operators import merge

    few, joined = merge.broadcast_checked, []

    def counted(*args):
        joined.append(1)
        return same_key(*args)

    same_key = merge.same_key
    monkeypatch.setattr(merge, "same_key", counted)
    base = [(i, f"a{i}", f"2024-01-{i % 9 + 1:02}", 1, f"d{i % 5}") for i in range(40)] + [(None, "a", "2024-01-01", 1, "d1"), (90, "alone", "2024-01-01", 1, "d8")]
    # Newer, equal and older versions, moves to another and to a new day, a day that empties, deletes, new keys, a null key.
    changes = [(i, f"b{i}", f"2024-01-{(i * 7) % 12 + 1:02}", i % 3, f"d{(i % 5 + (i % 4 == 0) * 2) if i % 11 else 7}") for i in range(0, 60, 2)]
    changes += [(None, "b", "2024-01-02", 1, "d2"), (90, "gone", "2024-02-01", 1, "d8"), (3, "gone", "2024-02-01", 1, "d3"), (77, "gone", "2024-02-01", 1, "d3")]
    found, told = [], []
    for way in (few, lambda df: df):
        monkeypatch.setattr(merge, "broadcast_checked", way)
        t = Keyed(folder("silver"), ["id"], ["event_ts", "ingest_ts"], ["dt"])
        merge_partitions(spark, t, spark.createDataFrame(base, SCHEMA))
        # A row that came in twice by another way: its key is not in the updates, so both stay.
        twice = [(91, "x", "2024-01-01", 1), (91, "x", "2024-01-01", 1)]
        spark.createDataFrame(twice, "id long, v string, event_ts string, ingest_ts int").write.mode("append").parquet(f"{t.path}/dt=d2")
        joined.clear()
        update = spark.createDataFrame([(*r, len(r)) for r in changes], SCHEMA + ", extra int")
        for _ in range(2):
            touched = merge_partitions(spark, t, update, deleted=F.col("v") == "gone", before_commit=told.append)
            found.append((rows(t.read(spark, update.schema).select(*update.columns)), sorted(v["dt"] for v in touched), sorted(v["dt"] for v in told[-1])))
        calls = len(joined)
    assert found[:2] == found[2:] and calls == 2
    got = {r[0]: r for r in found[0][0]}
    assert 90 not in got and 3 not in got and got[None][1] == "b" and sum(r[0] == 91 for r in found[0][0]) == 2
    assert {"d7", "d8"} <= set(found[0][1]) and not os.path.exists(f"{t.path}/dt=d8")
