"""Writers, overwrites, deletes and what the scans of the result look like."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeops.operators import layout
from lakeops.sources.tables import day_range, on_day
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def base(spark):
    """Three days; the second holds two thirds of the rows."""
    day = F.when(F.col("id") % 6 == 0, 0).when(F.col("id") % 6 == 1, 2).otherwise(1)
    return spark.range(600).select("id", (F.col("id") % 50).alias("v"), F.date_add(F.lit("2026-01-10").cast("date"), day).alias("dt"))


def test_one_file_per_partition(spark, base, folder):
    path = layout.write_table(base.repartition(6), folder(), partition_by=["dt"], rows_per_file=1000)
    assert {r["n_files"] for r in layout.file_audit(spark.read.parquet(path), ["dt"]).collect()} == {1}


def test_rebalanced_write_keeps_rows_and_few_files(spark, base, folder):
    path = layout.write_table(base.repartition(6), folder(), partition_by=["dt"])
    audit = layout.file_audit(spark.read.parquet(path), ["dt"])
    assert audit.agg(F.sum("n_rows"), F.max("n_files")).first()[:] == (600, 1)


def test_max_records_splits_files(spark, base, folder):
    path = layout.write_table(base, folder(), partition_by=["dt"], max_records=40)
    assert layout.file_audit(spark.read.parquet(path), ["dt"]).agg(F.max("max_rows_per_file")).first()[0] == 40


def test_hot_partition_is_written_by_several_tasks(spark, base, folder):
    one = layout.write_table(base, folder(), partition_by=["dt"])
    spread = spark.newSession()
    spread.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # such small pieces share a task otherwise
    path = layout.write_table(spread.read.parquet(one), folder(), partition_by=["dt"], rows_per_file=50)
    audit = {str(r["dt"]): r["n_files"] for r in layout.file_audit(spark.read.parquet(path), ["dt"]).collect()}
    assert audit["2026-01-10"] <= 2 and 2 <= audit["2026-01-11"] <= 8
    assert rows(spark.read.parquet(path).select("id")) == rows(base.select("id"))


def test_predicted_balance_is_what_repartitioning_gives(base):
    real = layout.partition_balance(base.repartition(5, "v"))
    assert rows(layout.predicted_balance(base, ["v"], 5)) == rows(real)


def test_hot_key_of_a_bucketed_table_is_spread(spark, folder):
    """Half of the rows on one key: several files in its bucket, one file in the others, all rows there."""
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    path = folder()
    table = layout.write_bucketed(df.repartition(6), "hot_" + path[-32:], ["k"], 8, path)
    files = spark.table(table).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count_if(F.col("k") == 7).alias("hot")).collect()
    assert sum(r["hot"] > 0 for r in files) > 1
    assert rows(spark.table(table)) == rows(df)


def test_publish_again_changes_nothing(spark, base, folder):
    path = folder()
    for _ in range(2):
        for d in (10, 11):
            layout.publish_day(base, path, "dt", date(2026, 1, d))
    assert spark.read.parquet(path).count() == 500


def test_publish_a_day_that_lost_its_rows(spark, base, folder):
    path = folder()
    layout.publish_day(base.limit(0), path, "dt", date(2026, 1, 10))
    layout.publish_day(base, path, "dt", "2026-01-10")
    layout.publish_day(base, path, "dt", date(2026, 1, 11))
    assert spark.read.parquet(path).count() == 500
    layout.publish_day(base.filter("dt > date'2026-01-10'"), path, "dt", date(2026, 1, 10))
    assert spark.read.parquet(path).count() == 400


def test_dynamic_overwrite_leaves_other_partitions(spark, base, folder):
    path = layout.write_table(base, folder(), partition_by=["dt"])
    one = spark.read.parquet(path).filter(F.col("dt") == date(2026, 1, 10)).withColumn("v", F.lit(-1).cast("long"))
    layout.overwrite_partitions(one, path, ["dt"])
    back = spark.read.parquet(path)
    assert back.count() == 600 and back.filter("v = -1").count() == 100


def test_delete_that_empties_a_partition(spark, base, folder):
    path = layout.write_table(base, folder(), partition_by=["dt"])
    layout.delete_where(spark, path, ["dt"], (F.col("dt") == date(2026, 1, 10)) | (F.col("v") == 7))
    want = base.filter("not (dt = date'2026-01-10' or v = 7)")
    assert rows(spark.read.parquet(path).select("id", "v", "dt")) == rows(want)


def test_delete_keeps_rows_for_which_the_condition_is_null(spark, folder):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "a")], "id int, v int, p string")
    path = layout.write_table(df, folder(), partition_by=["p"])
    layout.delete_where(spark, path, ["p"], F.col("v") > 3)
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [1]


def test_update_keeps_types_and_refuses_partition_moves(spark, base, folder):
    path = layout.write_table(base, folder(), partition_by=["dt"])
    layout.update_where(spark, path, ["dt"], F.col("v") == 3, {"v": F.lit(1000)})
    back = spark.read.parquet(path)
    assert back.schema["v"].dataType == base.schema["v"].dataType
    assert back.filter("v = 1000").count() == base.filter("v = 3").count()
    with pytest.raises(ValueError):
        layout.update_where(spark, path, ["dt"], F.col("v") == 3, {"dt": F.lit("2026-01-01")})


def test_compaction_keeps_rows_without_a_shuffle(spark, base, folder):
    small = folder()
    base.repartition(20).write.parquet(small)
    target = folder()
    planned = layout.compact(spark, small, target, 10**9)
    assert planned == 1 and spark.read.parquet(target).count() == 600
    assert layout.file_audit(spark.read.parquet(target), []).first()["n_files"] == 1


def test_partition_pruning_and_pushdown(spark, base, folder):
    path = layout.write_table(base.withColumn("ts", F.col("dt").cast("timestamp_ntz")), folder(), partition_by=["dt"])
    table = spark.read.parquet(path)
    pruned = plan(on_day(table, date(2026, 1, 10), "dt", "ts").select("id"))
    assert "PartitionFilters: [isnotnull(dt" in pruned
    pushed = plan(day_range(table, "ts", "2026-01-10", "2026-01-11").select("id"))
    assert "GreaterThanOrEqual(ts" in pushed and "ReadSchema: struct<id:bigint,ts:timestamp_ntz>" in pushed


def test_in_partitions_with_null_and_several_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "a")], "p int, q string")
    assert df.filter(layout.in_partitions([{"p": None}, {"p": 1}])).count() == 2
    assert df.filter(layout.in_partitions([{"p": 2, "q": None}])).count() == 1
    assert df.filter(layout.in_partitions([])).count() == 0
    many = layout.in_partitions([{"p": i, "q": "a"} for i in range(1000)])
    assert df.filter(many).count() == 1


@pytest.mark.parametrize("value", ["01", "4-NOT SPECIFIED", "a:b/c%d", "true"])
def test_update_and_delete_in_partitions_of_any_name(spark, folder, value):
    df = spark.createDataFrame([(1, 1, value), (2, 2, value), (3, 3, "02")], "id int, v int, p string")
    path = layout.write_table(df, folder(), partition_by=["p"])
    layout.update_where(spark, path, ["p"], F.col("p") == value, {"v": F.col("v") * 10})
    back = layout.read_if_any(spark, path, ["p"])
    assert rows(back.select("id", "v", "p")) == [(1, 10, value), (2, 20, value), (3, 3, "02")]
    layout.delete_where(spark, path, ["p"], F.col("id") < 3)
    assert rows(layout.read_if_any(spark, path, ["p"]).select("id", "v", "p")) == [(3, 3, "02")]
    assert [d for d in os.listdir(path) if d.startswith("p=")] == ["p=02"]
    layout.delete_where(spark, path, ["p"], F.lit(True))
    assert layout.read_if_any(spark, path, ["p"]).count() == 0


def test_delete_timestamp_partition(spark, folder):
    df = spark.sql("SELECT 1 id, timestamp'2026-01-01 10:00:00' p UNION ALL SELECT 2, timestamp'2026-01-02 00:00:00'")
    path = layout.write_table(df, folder(), partition_by=["p"])
    layout.delete_where(spark, path, ["p"], F.col("p") < "2026-01-02", df.schema)
    assert [r["id"] for r in layout.read_if_any(spark, path, ["p"], df.schema).collect()] == [2]
    assert len([d for d in os.listdir(path) if d.startswith("p=")]) == 1
