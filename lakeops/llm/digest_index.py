"""Exact deduplication against a persistent index of text digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import free_name, lookup, text_of, written

#: White space that does not make texts different: blank, and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"

DIGEST, CHARS, ORDER, ROW = "__digest", "__chars", "__order", "__row"


def digest_of(column: str = "text") -> Column:
    """SHA-256 of the text without blanks, lowercase hex; null counts as empty."""
    return F.sha2(F.translate(text_of(column), BLANKS, "").cast("binary"), 256)


class DigestIndex:
    """A table of digests under `path`, bucketed and sorted by digest, one partition per batch.

    A batch is written as one overwrite of its own partition, so a batch that runs again
    replaces what it wrote and sees only the other batches. The bucket count belongs to
    the folder's name: opened again, the index keeps the count it was made with.
    """

    COLUMNS = "digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        there = self._made_with(path)
        self.buckets = there or buckets
        self.path = f"{path.rstrip('/')}/digests-in-{self.buckets}"
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({self.COLUMNS}) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if there:
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def _made_with(self, path: str) -> int | None:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        counts = [int(n.removeprefix("digests-in-")) for n in names if n.startswith("digests-in-")]
        return counts[0] if counts else None

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def fresh(self, digests: DataFrame, batch: str) -> DataFrame:
        """Those of the digests (one row each) that no other batch has brought: a sort-merge
        anti-join, for which only the new digests are shuffled."""
        known = self.read().filter(F.col("batch") != batch).select("digest")
        return digests.repartition(self.buckets, "digest").join(known.hint("merge"), "digest", "left_anti")

    def append(self, digests: DataFrame, batch: str) -> None:
        """Write the batch's new digests: one file per bucket, as each task holds one bucket."""
        view = f"new_{uuid.uuid4().hex}"
        # Spark refuses to overwrite what the same statement reads.
        rows = written(self.fresh(digests.select("digest", "keep_id", "group_size"), batch), "new-digests")
        rows.repartition(self.buckets, "digest").createOrReplaceTempView(view)
        quoted = batch.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = '{quoted}') SELECT digest, keep_id, group_size FROM {view}"
        )
        self.spark.catalog.dropTempView(view)

    def close(self) -> None:
        """Forget the name in the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE {self.table}")


def judged(docs: DataFrame, index: DigestIndex, batch: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: the key, keep_id, group_size, kept, text_sha256 and `__row`.

    Texts are equal when their digests are. Of equal texts in a batch the row with the most
    code points stays, then the smallest key (null last), then the first row of those
    repeated whole. A text that an earlier batch of the index has is dropped in favour of
    that batch's row. group_size counts the rows of this batch with the text, and those of
    the batch that kept it. Null texts equal empty ones. An empty frame gives no rows.

    `docs` must give the same rows in the same partitions when it is computed again, as a
    scan does: `__row` numbers its rows. Other columns are not looked at.
    """
    rows = docs.select(
        F.col(key).alias("__key"), digest_of(text).alias("digest"), F.length(text_of(text)).alias(CHARS),
        F.monotonically_increasing_id().alias(ROW),
    )
    rows = written(rows, "digests")
    total = rows.count()
    order = F.struct((-F.col(CHARS)).alias("c"), F.col("__key").isNull().alias("n"), F.col("__key").alias("k"), F.col(ROW).alias("r"))
    best = rows.groupBy("digest").agg(F.min(order).alias(ORDER), F.count(F.lit(1)).alias("__size"))
    best = best.select("digest", F.col(f"{ORDER}.k").alias("keep_id"), F.col(f"{ORDER}.r").alias("__keep"), "__size")
    best = written(best, "digest-groups")
    index.append(best.select("digest", "keep_id", F.col("__size").alias("group_size")), batch)
    # The index now holds every digest: of this batch, or of the one that brought it first.
    known = index.read().select("digest", F.col("keep_id").alias("__id"), F.col("group_size").alias("__n"), "batch")
    ours = F.col("batch") == batch
    best = best.join(known.hint("merge"), "digest").select(
        "digest", F.col("__id").alias("keep_id"), F.when(ours, F.col("__keep")).alias("__keep"), "__size",
        F.when(ours, F.col("__n")).otherwise(F.col("__n") + F.col("__size")).alias("group_size"),
    )
    found = lookup(rows, best, "digest", "__size", total)
    return found.select(
        F.col("__key").alias(key), "keep_id", "group_size", F.coalesce(F.col(ROW) == F.col("__keep"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"), ROW,
    )


def first_copies(docs: DataFrame, index: DigestIndex, batch: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns. The join is on row numbers, so no text is hot."""
    kept = judged(docs, index, batch, key, text).filter("kept").select(ROW)
    row = free_name(docs, ROW)
    kept = kept.withColumnRenamed(ROW, row)
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").select(docs.columns)
