"""Versions of partitions that the catalog switches between."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeops.operators.staged import StagedTable
from tests.conftest import rows

ONE, TWO = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def table(spark, folder):
    made = spark.createDataFrame([], "id long, x string, dt date, kind string")
    t = StagedTable(f"staged_{uuid.uuid4().hex}", folder("staged"), made.schema, ["dt", "kind"]).create(spark)
    yield t
    spark.sql(f"DROP TABLE {t.name}")


def frame(spark, *data):
    return spark.createDataFrame(data, "id long, x string, dt date, kind string")


def test_switch_backup_and_restore(spark, table):
    a, odd, none = {"dt": ONE, "kind": "a"}, {"dt": TWO, "kind": "it's a/b=c"}, {"dt": TWO, "kind": None}
    first = frame(spark, (1, "old", ONE, "a"), (2, "old", TWO, odd["kind"]), (3, "old", TWO, None), (4, "elsewhere", TWO, "z"))
    table.publish(first, [a, odd, none])
    old = [(1, "old", ONE, "a"), (2, "old", TWO, odd["kind"]), (3, "old", TWO, None)]
    assert rows(table.read(spark)) == sorted(old, key=repr)
    assert table.read(spark).filter(F.col("dt") == F.lit(ONE)).count() == 1
    # A version that is only staged, or whose writing was cut off, is not seen.
    n = table.stage(frame(spark, (1, "new", ONE, "a"), (9, "new", ONE, "a")), [a])
    assert rows(table.read(spark)) == sorted(old, key=repr)
    table.switch(spark, n, [a])
    assert {r.x for r in table.read(spark).filter("kind = 'a'").collect()} == {"new"} and table.version_of(spark, a) == n
    # From the table itself, and a partition that gets no rows.
    table.publish(table.read(spark).filter("id <> 2").withColumn("x", F.lit("own")), [a, odd])
    assert rows(table.read(spark)) == sorted([(1, "own", ONE, "a"), (9, "own", ONE, "a"), (3, "old", TWO, None)], key=repr)
    table.restore(spark, [odd, a])
    assert rows(table.read(spark).filter("kind is not null")) == sorted([(1, "new", ONE, "a"), (9, "new", ONE, "a"), old[1]], key=repr)
    table.restore(spark, [a, none])
    assert rows(table.read(spark)) == sorted(old[:2], key=repr)


def test_cut_off_versions_and_expiry(spark, table):
    a = {"dt": ONE, "kind": "a"}
    for i in range(4):
        assert table.publish(frame(spark, (i, "x", ONE, "a")), [a]) == i + 1
    files, _ = table._files(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files.delete(path(f"{table.root}/v=3/_SUCCESS"), False)
    assert table.backups(spark, a) == [2, 1]
    with pytest.raises(ValueError, match="not complete"):
        table.switch(spark, 3, [a])
    table.expire(spark, [a])
    assert table.backups(spark, a) == [2]
    assert [r.id for r in table.read(spark).collect()] == [3]
    table.restore(spark, [a])
    assert [r.id for r in table.read(spark).collect()] == [1]
    # What was withdrawn is no backup, nor what was only staged.
    table.stage(frame(spark, (8, "x", ONE, "a")), [a])
    assert table.publish(frame(spark, (7, "x", ONE, "a")), [a]) == 6
    table.restore(spark, [a])
    assert [r.id for r in table.read(spark).collect()] == [1]
