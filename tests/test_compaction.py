"""Selective compaction: which files move, replays, and compactions that are cut off."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators import compaction
from lakeops.operators.compaction import compact_small, compaction_plan, files_of, finish_compaction
from tests.conftest import rows


def table(spark, path):
    """Two small folders, one of them with an awkward name, and a folder with one large and three small files."""
    names = F.when(F.col("id") % 3 == 0, "a b%[x]").when(F.col("id") % 3 == 1, "plain").otherwise("mixed")
    df = spark.range(900).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), names.alias("p"))
    df.repartition(3, "id").write.partitionBy("p").parquet(path)
    big = spark.range(900, 9000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("mixed").alias("p"))
    big.coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    return path


def names(spark, path):
    return {r["file"]: r["bytes"] for r in files_of(spark, path).collect()}


def test_plan_packs_each_folder_by_size(spark):
    files = [("a/1", 10), ("a/2", 20), ("a/3", 30), ("a/4", 45), ("a/5", 60), ("b/1", 5), ("c/1", 0), ("c/2", 0)]
    df = spark.createDataFrame([(f, f, f[0], n) for f, n in files], "file string, uri string, folder string, bytes long")
    got = {(r["file"], r["bin"]) for r in compaction_plan(df, 100, 0.5).collect()}
    # 60 is large, b has one file only; the bin of a is 105 bytes.
    assert got == {("a/1", 0), ("a/2", 0), ("a/3", 0), ("a/4", 0), ("c/1", 0), ("c/2", 0)}
    assert {r["bin"] for r in compaction_plan(df.filter("folder = 'a'"), 50, 0.95).collect()} == {0}


def test_large_files_are_untouched_and_a_replay_changes_nothing(spark, folder):
    path = table(spark, folder())
    before, want = names(spark, path), rows(spark.read.parquet(path))
    large = max(before, key=before.get)
    assert compact_small(spark, path, before[large]) == len(before) - 1
    after = names(spark, path)
    assert large in after and not (set(before) - {large}) & set(after) and len(after) == 4
    assert rows(spark.read.parquet(path)) == want
    assert compact_small(spark, path, before[large] // 100) == 0 and names(spark, path) == after


def test_a_flat_table_with_columns_added_later(spark, folder):
    path = folder()
    for n in range(3):
        spark.range(n, n + 2).withColumns({f"c{n}": F.lit(n)}).coalesce(1).write.mode("append").parquet(path)
    read = spark.read.option("mergeSchema", "true")
    want = rows(read.parquet(path).select("id", "c0", "c1", "c2"))
    assert compact_small(spark, path) == 3
    assert rows(read.parquet(path).select("id", "c0", "c1", "c2")) == want and len(names(spark, path)) == 1


def test_files_without_rows_stay(spark, folder):
    path = folder()
    for _ in range(2):
        spark.range(3).filter("id > 5").coalesce(1).write.mode("append").parquet(path)
    before = names(spark, path)
    compact_small(spark, path)
    assert names(spark, path) == before and spark.read.parquet(path).count() == 0


@pytest.mark.parametrize("when", ["before the rows are written", "before a bin moves", "after the first move", "before sources go"])
def test_cut_off_and_finished(spark, folder, monkeypatch, when):
    path = table(spark, folder())
    before, want = names(spark, path), rows(spark.read.parquet(path))

    class Cut(Exception):
        pass

    real, moves = compaction._files, []

    class Files:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def rename(self, *args):
            moves.append(1)
            if when == "before a bin moves" or (when == "after the first move" and len(moves) == 2):
                raise Cut
            return self.files.rename(*args)

        def delete(self, place, recursive):
            if when == "before sources go" and not recursive:
                raise Cut
            return self.files.delete(place, recursive)

    def wrapped(spark, path):
        files, place = real(spark, path)
        return Files(files), place

    def refused(_):
        raise Cut

    with monkeypatch.context() as m:
        m.setattr(compaction, "_files", wrapped)
        if when.startswith("before the rows"):
            m.setattr(compaction, "broadcast_checked", refused)
        with pytest.raises(Cut):
            compact_small(spark, path, max(before.values()))
    finish_compaction(spark, path)
    assert rows(spark.read.parquet(path)) == want
    assert len(names(spark, path)) == (len(before) if when.startswith("before the rows") else 4)
    assert compact_small(spark, path, max(before.values())) == (len(before) - 1 if when.startswith("before the rows") else 0)
