"""Table layout: writes, dynamic partition overwrite, buckets, audit, compaction."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)
from pyspark.sql.utils import AnalysisException

from lakeops.functions.nested import stable_hash
from lakeops.operators.skew import hot_keys
from lakeops.session import shuffle_partitions, sibling_session


def read_if_any(
    spark: SparkSession, path: str, part_cols: Sequence[str] = (), types: StructType | None = None
) -> DataFrame | None:
    """The Parquet table at a path, or None before anything is written there.

    With `part_cols` it has every column that any of its files has, and the partition columns
    have their type in `types` or are text, as in the folders' names: Spark would make
    the number 1 of a folder "01", and write it back to another.
    """
    try:
        table = spark.read.option("mergeSchema", bool(part_cols)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if not part_cols:
        return table
    known = {f.name: f.dataType for f in types or [] if f.name in part_cols}
    fields = [
        StructField(f.name, known.get(f.name, StringType()) if f.name in part_cols else f.dataType) for f in table.schema
    ]
    return spark.read.schema(StructType(fields)).parquet(path)


def as_type(value, kind: DataType):
    """A partition value as the column's type: a day may come as a date or as its text."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        if isinstance(value, bool):
            return str(value).lower()
        return value if isinstance(value, str) else str(value)
    if isinstance(kind, DateType):
        return value.date() if isinstance(value, datetime) else date.fromisoformat(str(value))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else str(value).lower() == "true"
    if isinstance(kind, IntegralType):
        return int(value)
    return value


def clustered(df: DataFrame, partition_by: Sequence[str], rows_per_file: int | None = None) -> DataFrame:
    """Rows gathered by partition key before a partitioned write, for few files per partition.

    By default Spark balances the pieces: small partitions share a task and a hot one is
    split over several, each near the advisory size. With `rows_per_file` a partition of
    n rows goes to at most ceil(n / rows_per_file) files, each by its own task.
    """
    if not partition_by:
        return df
    if rows_per_file is None:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    # One row per partition of the table to be written.
    sizes = df.groupBy(*partition_by).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("__slots"))
    sizes = sizes.select(*[F.col(c).alias(f"__p_{c}") for c in partition_by], "__slots")
    match = F.lit(True)
    for c in partition_by:
        match = match & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    slot = F.pmod(stable_hash(df), F.col("__slots"))
    slotted = df.join(F.broadcast(sizes), match, "left").select(*df.columns, slot.alias("__slot"))
    return slotted.repartition(*[F.col(c) for c in partition_by], F.col("__slot")).drop("__slot")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    gather: bool = True,
    rows_per_file: int | None = None,
    max_records: int | None = None,
) -> str:
    """Parquet write; partitioned writes gather rows by partition key first."""
    out = clustered(df, partition_by, rows_per_file) if gather else df
    writer = out.write.mode(mode)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    return write_table(df, path, "append", partition_by)


def catalog_append(df: DataFrame, table: str, path: str | None = None) -> None:
    """INSERT INTO a catalog table, made on first use."""
    writer = df.write.mode("append").format("parquet")
    if path and not df.sparkSession.catalog.tableExists(table):
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], gather: bool = True) -> str:
    """Replace only the partitions present in the data.

    The committer stages all files and moves them in when the job commits, so a failed
    job leaves the table as it was, and the data may come from the table itself. Without
    `gather` rows are written by the tasks that hold them.
    """
    (
        (clustered(df, partition_by) if gather else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return path


def publish_day(df: DataFrame, path: str, part_col: str, day) -> str:
    """Publish one day; running it again gives the same table, and a day without rows ends up empty."""
    refresh_partitions(df.filter(F.col(part_col) == F.lit(day)), path, [part_col], [{part_col: day}])
    return path


def buckets_for(df: DataFrame, target_bytes: int = 256 * 1024 * 1024, least: int = 8) -> int:
    """Number of buckets, a power of two, that makes a bucket of a scanned table about the target size."""
    n = least
    while n * target_bytes < table_bytes(df):
        n *= 2
    return n


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> str:
    """A table bucketed and sorted by key.

    Rows are gathered so that a bucket is one file. Where a key exceeds an average bucket,
    its rows are written by many tasks instead, as several files of the same bucket.
    """
    # Fewer keys than buckets can hold more than an average bucket.
    hot = hot_keys(df, keys[0], 1.0 / buckets).select(F.col(keys[0]).alias("__hot"))
    if hot.take(1):
        bucket = F.pmod(F.hash(*keys), F.lit(buckets))
        n = max(buckets, shuffle_partitions(df.sparkSession))
        slot = F.when(F.col("__hot").isNotNull(), F.pmod(stable_hash(df), F.lit(n))).otherwise(F.lit(0))
        marked = df.join(F.broadcast(hot), F.col(keys[0]) == F.col("__hot"), "left")
        gathered = marked.repartition(n, bucket, slot).drop("__hot")
    else:
        gathered = df.repartition(buckets, *keys)
    (
        gathered.write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )
    return table


def empty_partitions(table: DataFrame, path: str, values: Sequence[dict]) -> None:
    """Remove the folders of the given partitions of a table, as `read_if_any` gave it.

    A dynamic overwrite leaves a partition alone when no row falls into it. The folders are
    those that the partitions' files are in, found in one job, whatever signs the values
    hold. A table that would have no file left keeps an empty one in the last folder.
    """
    if not values:
        return
    spark = table.sparkSession
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    # One row per emptied partition.
    gone = [unquote(r["d"]) for r in table.filter(in_partitions(values)).select(folder.alias("d")).distinct().collect()]
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in gone:
        files.delete(jvm.Path(d), True)
    if gone and read_if_any(spark, path) is None:
        body = spark.createDataFrame([], table.drop(*values[0]).schema)
        body.write.mode("overwrite").parquet(gone[-1])


def partition_values(df: DataFrame, part_cols: Sequence[str]) -> list[dict]:
    """Distinct partition values: control data, bounded by the table's number of partitions."""
    return [r.asDict() for r in df.select(*part_cols).distinct().collect()]


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str], touched: Sequence[dict]) -> None:
    """Replace the touched partitions by what the frame holds for them, which may be nothing."""
    with reused(df) as rows:
        overwrite_partitions(rows, path, partition_by)
        alive = partition_values(rows, partition_by)
    wanted = [{c: as_type(v[c], df.schema[c].dataType) for c in partition_by} for v in touched]
    gone = [v for v in wanted if v not in alive]
    table = read_if_any(df.sparkSession, path, partition_by, df.schema) if gone else None
    if table is not None:
        empty_partitions(table, path, gone)


def in_partitions(values: Sequence[dict]) -> Column:
    """A predicate on partition columns as literals, so that the scan is pruned when planned."""
    if not values:
        return F.lit(False)
    # The column with most values comes last, where all of them fit into one IN list.
    first, *rest = sorted(values[0], key=lambda c: len({v[c] for v in values}))
    if not rest:
        known = [v[first] for v in values if v[first] is not None]
        keep = F.col(first).isin(known) if known else F.lit(False)
        return keep | F.col(first).isNull() if len(known) < len(values) else keep
    groups: dict = {}
    for v in values:
        groups.setdefault(v[first], []).append({c: v[c] for c in rest})
    return _any([F.col(first).eqNullSafe(F.lit(v)) & in_partitions(sub) for v, sub in groups.items()])


def _any(conditions: list[Column]) -> Column:
    """OR as a balanced tree: a chain of thousands would be too deep for the analyser."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def update_where(
    spark: SparkSession,
    path: str,
    part_cols: Sequence[str],
    condition: Column,
    assignments: dict[str, Column],
    types: StructType | None = None,
) -> None:
    """UPDATE on a Parquet table: rows that match get the new values, types kept.

    Partition columns are text in `condition` unless `types` has others for them.
    """

    def change(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: F.when(condition, value.cast(df.schema[c].dataType)).otherwise(F.col(c))
                for c, value in assignments.items()
            }
        )

    if set(assignments) & set(part_cols):
        raise ValueError("moving rows between partitions is a merge, not an update")
    table = read_if_any(spark, path, part_cols, types)
    touched = partition_values(table.filter(condition), part_cols)
    if touched:
        overwrite_partitions(change(table.filter(in_partitions(touched))), path, part_cols)


def delete_where(
    spark: SparkSession, path: str, part_cols: Sequence[str], condition: Column, types: StructType | None = None
) -> None:
    """DELETE on a Parquet table; a partition that loses all its rows goes.

    Partition columns are text in `condition` unless `types` has others for them.
    """
    table = read_if_any(spark, path, part_cols, types)
    touched = partition_values(table.filter(condition), part_cols)
    if not touched:
        return
    rest = table.filter(in_partitions(touched) & ~F.coalesce(condition, F.lit(False)))
    alive = partition_values(rest, part_cols)
    if alive:
        overwrite_partitions(rest, path, part_cols)
    empty_partitions(table, path, [v for v in touched if v not in alive])


def file_audit(df: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """Files and rows per partition of a scanned table."""
    per_file = df.groupBy(*part_cols, F.col("_metadata.file_path").alias("__f")).agg(F.count(F.lit(1)).alias("__n"))
    return per_file.groupBy(*part_cols).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("__n").alias("n_rows"), F.max("__n").alias("max_rows_per_file")
    )


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a scanned table."""
    sizes = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.max("_metadata.file_size").alias("b"))
    return sizes.agg(F.sum("b").alias("b")).first()["b"] or 0


def compact(
    spark: SparkSession, source: str, target: str, target_bytes: int = 128 * 1024 * 1024, partition_by: Sequence[str] = ()
) -> int:
    """Rewrite a table into files of about the target size; returns ceil(bytes / target_bytes).

    Without partitions nothing is shuffled: the scan packs small files into read tasks of
    the target size, and each task writes one file. The packing settings live in a sibling
    session. A partitioned table is gathered by partition instead.
    """
    planned = max(1, -(-table_bytes(spark.read.parquet(source)) // target_bytes))
    if partition_by:
        write_table(spark.read.parquet(source), target, partition_by=partition_by)
        return planned
    packed = sibling_session(
        spark,
        spark__sql__files__maxPartitionBytes=str(target_bytes),
        spark__sql__files__openCostInBytes="0",
        spark__sql__files__minPartitionNum="1",
    )
    packed.read.parquet(source).write.mode("overwrite").parquet(target)
    return planned


def partition_balance(df: DataFrame) -> DataFrame:
    """Rows per in-memory partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def predicted_balance(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows per partition that repartitioning by the keys would give, without moving a row."""
    slot = F.pmod(F.hash(*keys), F.lit(n))
    return df.groupBy(slot.alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """A frame that several actions read, kept until the block ends.

    Kept blocks carry their lineage, so a lost executor costs a recomputation only.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
