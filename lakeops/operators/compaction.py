"""Selective compaction: only a table's small files are written together, large ones are not opened.

A plan packs each folder's small files into bins of about the target size. The bins are written beside the
table, in a folder that readers pass over, and then moved in; the plan stays there until all of it is done, so
a compaction that was cut off is finished, or forgotten if nothing was moved yet, by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import broadcast_checked
from lakeops.operators.layout import read_if_any

_WORK = "_compaction"
_BIN = "__bin"


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, uri, folder, bytes) of every Parquet file of a table, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return listed.select(F.col("path").alias("file"), F.col("_metadata.file_path").alias("uri"), folder.alias("folder"), F.col("length").alias("bytes"))


def compaction_plan(files: DataFrame, target_bytes: int, small_share: float = 0.5) -> DataFrame:
    """(file, uri, folder, bytes, bin): the files below a share of the target size, by the bin they go to.

    Along a folder's small files, the smallest first, a bin begins with every target size that is
    reached, so it has up to (1 + small_share) times the target. A bin of one file is left out.
    """
    along = Window.partitionBy("folder").orderBy("bytes", "file")
    before = F.sum("bytes").over(along) - F.col("bytes")
    small = files.filter(F.col("bytes") < F.lit(target_bytes * small_share))
    placed = small.withColumn("bin", F.floor(before / F.lit(target_bytes)).cast("long"))
    together = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return placed.withColumn("__n", together).filter("__n > 1").drop("__n")


def compact_small(spark: SparkSession, path: str, target_bytes: int = 128 * 1024 * 1024, small_share: float = 0.5) -> int:
    """Write a table's small files together, by folder; returns how many files went into others.

    Large files keep their names and are not read. Running it again changes nothing more, save for bins
    that have become small ones themselves. The list of small files, which the reader keeps on the driver
    anyway, is what the driver holds. Files without rows stay. One writer at a time: a reader between a bin's move and the removal of its
    sources sees their rows twice; where that matters, publish by `StagedTable`.
    """
    finish_compaction(spark, path)
    work = f"{path}/{_WORK}/{uuid.uuid4().hex}"
    plan = compaction_plan(files_of(spark, path), target_bytes, small_share)
    # Bins have numbers of their own in the whole table.
    number = F.xxhash64("folder", "bin").alias(_BIN)
    plan.select("file", "uri", "folder", number).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    sources = [r["file"] for r in plan.select("file").toLocalIterator()]
    if sources:
        # Files read one by one have no partition columns: those stay in the folders' names.
        rows = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*map(_literal, sources))
        bins = plan.select(F.col("uri").alias("__uri"), _BIN)
        tagged = rows.withColumn("__uri", F.col("_metadata.file_path")).join(broadcast_checked(bins), "__uri").drop("__uri")
        n = plan.select(_BIN).distinct().count()
        tagged.repartition(n, _BIN).write.partitionBy(_BIN).parquet(f"{work}/rows")
    finish_compaction(spark, path)
    return len(sources)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Finish what a compaction that was cut off had written whole; remove what it had not."""
    files, place = _files(spark, path)
    for work in list(_children(files, place(f"{path}/{_WORK}"))):
        plan = read_if_any(spark, f"{work}/plan") if files.exists(place(f"{work}/rows/_SUCCESS")) else None
        if plan is not None:
            written = {int(f.split(f"{_BIN}=")[1]): f for f in _children(files, place(f"{work}/rows")) if f"{_BIN}=" in f}
            for row in plan.select(_BIN, "folder").distinct().toLocalIterator():
                # A bin whose files have no rows has nothing to move, and its files stay.
                for part in list(_children(files, place(written[row[_BIN]]))) if row[_BIN] in written else []:
                    # What was moved before has left its folder, so each part moves once.
                    if not files.rename(place(part), place(f"{row['folder']}/{part.rsplit('/', 1)[1]}")):
                        raise OSError(f"{part} could not be moved to {row['folder']}")
            for row in plan.select("file", _BIN).toLocalIterator():
                if row[_BIN] in written:
                    files.delete(place(row["file"]), False)
        files.delete(place(work), True)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(files, folder) -> Iterator[str]:
    if files.exists(folder):
        for status in files.listStatus(folder):
            name = status.getPath().toString()
            if not name.rsplit("/", 1)[1].startswith((".", "_SUCCESS")):
                yield name


def _literal(path: str) -> str:
    """A path without signs of a pattern."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)
