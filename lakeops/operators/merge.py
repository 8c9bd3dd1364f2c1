"""Latest-wins merge on partitioned Parquet, shared by batch jobs and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.nested import stable_hash
from lakeops.operators.joins import broadcast_checked
from lakeops.operators.key_index import AT, GONE, KeyIndex, same_key
from lakeops.operators.layout import (
    clustered,
    empty_partitions,
    in_partitions,
    overwrite_partitions,
    partition_values,
    read_if_any,
    reused,
)
from lakeops.operators.windows import latest
from lakeops.session import scratch_root

RANK = "__source_rank"
#: True for rows whose key is among the updates.
UPDATED = "__updated"
#: In a frame of changes: -1 for a version that leaves the table, 1 for one that enters it.
SIGN = "__sign"


@dataclass(frozen=True)
class Keyed:
    """A partitioned table with one row per key; `order` says which version is newer.

    `indexed` names a folder for an index of its keys, which merges then use and keep.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    part_cols: Sequence[str]
    indexed: str | None = None
    index_options: dict = field(default_factory=dict)

    @property
    def index(self) -> KeyIndex | None:
        if self.indexed is None:
            return None
        return KeyIndex(self.indexed, tuple(self.keys), tuple(self.part_cols), tuple(self.order), **self.index_options)

    def read(self, spark: SparkSession, types: StructType) -> DataFrame | None:
        """The table with all columns it ever had, and partition columns as in `types`."""
        return read_if_any(spark, self.path, self.part_cols, types)


def newest(df: DataFrame, table: Keyed) -> DataFrame:
    return latest(df, table.keys, table.order)


def merge_versions(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key of both; with equal order values the new side wins."""
    both = old.withColumn(RANK, F.lit(0)).unionByName(new.withColumn(RANK, F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, order, extra=[F.col(RANK).desc()]).drop(RANK)


def merge_partitions(
    spark: SparkSession,
    table: Keyed,
    updates: DataFrame,
    key_stays_in_partition: bool = False,
    deleted: Column | None = None,
    before_commit: Callable[[list[dict]], None] | None = None,
    changes: Callable[[DataFrame], None] | None = None,
) -> list[dict]:
    """Merge updates into the table by key, newest version first, and return the partitions touched.

    Touched are the partitions of the new rows and those that already hold one of their
    keys, so that a correction which moves a key leaves no second version behind. With
    `key_stays_in_partition` the caller vouches that keys never move, and only the
    partitions of the new rows are read.

    Rows of touched partitions whose key is not in the updates pass through an anti join
    against the updates' keys and are not shuffled when those keys are few: the tasks that
    scan them write them. With many keys whole rows are shuffled by key once, for the newest
    versions and the other rows together. Columns that either side lacks are null there, and none is
    dropped. `deleted` marks change rows that remove their key (no trace of the key is
    kept, so an older version that arrives after its delete counts as new). Touched
    partitions are replaced by one dynamic overwrite, then those with nothing left are
    removed; running it again with the same updates, after a crash in between as well, gives
    the same table. `before_commit` is told the partitions that are about to be replaced.
    `changes` gets, before that too, the old and the new versions of the updates' keys with SIGN;
    a version that stays is in it with both signs.

    A table with an index looks its updates' keys up in their buckets instead, and deletes
    leave tombstones: an older version that arrives after its delete stays out.
    """
    parts = list(table.part_cols)
    with reused(newest(updates, table)) as fresh:
        if table.index:
            return _merge_indexed(spark, table, fresh, deleted, before_commit, changes)
        target = table.read(spark, fresh.schema)
        if target is None:
            kept = fresh.filter(~F.coalesce(deleted, F.lit(False))) if deleted is not None else fresh
            touched = partition_values(kept, parts)
            if changes:
                changes(_signed(None, kept))
            if before_commit:
                before_commit(touched)
            overwrite_partitions(kept, table.path, parts)
            return touched
        columns = target.columns + [c for c in fresh.columns if c not in target.columns]
        slim = fresh.select(*table.keys)
        keys_side = broadcast_checked(slim)
        if key_stays_in_partition:
            candidates = partition_values(fresh, parts)
        else:
            # Keys only, and only their range: whole rows are read from the partitions found.
            probe = target.filter(_key_range(fresh, table.keys)).select(*table.keys, *parts)
            candidates = partition_values(same_key(probe, keys_side, table.keys, "left_semi"), parts)
            if keys_side is slim and changes is None:
                return _merge_shuffled(table, target, fresh, candidates, deleted, before_commit)
        scope = target.filter(in_partitions(candidates))
        scratch_root(spark)
        with reused(same_key(scope, keys_side, table.keys, "left_semi")) as held:
            was = partition_values(held, parts)
            # Cut off from the table's files, which are about to be replaced.
            winners = merge_versions(held, fresh, table.keys, table.order).checkpoint()
            kept = winners.filter(~F.coalesce(deleted, F.lit(False))) if deleted is not None else winners
            if changes:
                changes(_signed(held, kept))
        now = partition_values(kept, parts)
        touched = now + [v for v in was if v not in now]
        if not touched:
            return []
        if before_commit:
            before_commit(touched)
        rest = same_key(target.filter(in_partitions(touched)), keys_side, table.keys, "left_anti")
        # Partitions that lost a key and got none back may have nothing left.
        at_risk = [v for v in was if v not in now]
        alive = partition_values(rest.filter(in_partitions(at_risk)), parts) if at_risk else []
        gone = [v for v in at_risk if v not in alive]
        merged = rest.unionByName(clustered(kept, parts), allowMissingColumns=True).select(*columns)
        overwrite_partitions(merged, table.path, parts, gather=False)
    empty_partitions(target, table.path, gone)
    return touched


def _merge_shuffled(
    table: Keyed,
    target: DataFrame,
    fresh: DataFrame,
    was: list[dict],
    deleted: Column | None,
    before_commit: Callable[[list[dict]], None] | None,
) -> list[dict]:
    """`merge_partitions` for updates that are too many to broadcast; `was` are all partitions that hold one of their keys.

    One window by key over those partitions and the updates finds the newest versions, and lets the rows of
    other keys through as they are. Its rows are read before the table's files are replaced, and not
    afterwards, so they need no checkpoint.
    """
    parts = list(table.part_cols)
    columns = target.columns + [c for c in fresh.columns if c not in target.columns]
    old, new = target.filter(in_partitions(was)).withColumn(RANK, F.lit(0)), fresh.withColumn(RANK, F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    # The order of `merge_versions`.
    by_key = Window.partitionBy(*table.keys).orderBy(*[F.col(c).desc_nulls_last() for c in table.order], F.col(RANK).desc(), stable_hash(both).desc())
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = both.withColumns({UPDATED: F.max(RANK).over(whole) == 1, "__n": F.row_number().over(by_key)})
    with reused(numbered.filter(~F.col(UPDATED) | (F.col("__n") == 1)).drop(RANK, "__n")) as rows:
        left = rows.filter(~F.col(UPDATED) | ~F.coalesce(deleted, F.lit(False))) if deleted is not None else rows
        now = partition_values(left.filter(UPDATED), parts)
        touched = now + [v for v in was if v not in now]
        if not touched:
            return []
        if before_commit:
            before_commit(touched)
        at_risk = [v for v in was if v not in now]
        alive = partition_values(left.filter(in_partitions(at_risk)), parts) if at_risk else []
        # No key of the updates is there yet.
        others = target.filter(in_partitions([v for v in now if v not in was]))
        merged = left.drop(UPDATED).unionByName(others, allowMissingColumns=True).select(*columns)
        overwrite_partitions(merged, table.path, parts)
    empty_partitions(target, table.path, [v for v in at_risk if v not in alive])
    return touched


def _merge_indexed(
    spark: SparkSession,
    table: Keyed,
    fresh: DataFrame,
    deleted: Column | None,
    before_commit: Callable[[list[dict]], None] | None,
    changes: Callable[[DataFrame], None] | None,
) -> list[dict]:
    """`merge_partitions` by the index: reads the buckets of the updates' keys and the partitions
    that these name, with the table's schema from the index and so without looking into its files."""
    index, parts, keys = table.index, list(table.part_cols), list(table.keys)
    state = index.state(spark)
    if state is None:
        known = table.read(spark, fresh.schema)
        state = index.build(spark, known, fresh.schema if known is None else known.schema)
    there = spark._jvm.org.apache.hadoop.fs.Path(table.path)
    empty = not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
    target = spark.createDataFrame([], state.schema) if empty else spark.read.schema(state.schema).parquet(table.path)
    schema = StructType(list(state.schema.fields))
    for f in fresh.schema:
        if f.name not in schema.names:
            schema.add(f.name, f.dataType, True)
    marked = fresh.withColumn(GONE, F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    keys_side = broadcast_checked(fresh.select(*keys))
    scratch_root(spark)
    entries = index.lookup(spark, state, fresh) if state.versions else None
    with reused(entries if entries is not None else spark.createDataFrame([], index._schema(state.schema))) as found:
        candidates = partition_values(found.filter(~F.col(GONE)), parts)
        held = same_key(target.filter(in_partitions(candidates)), keys_side, keys, "left_semi").withColumn(GONE, F.lit(False))
        tombs = found.filter(GONE).select(*dict.fromkeys([*keys, *table.order]), GONE)
        with reused(held) as was_held:
            was = partition_values(was_held, parts)
            # Cut off from the table's and the index's files, which are about to be replaced.
            winners = merge_versions(was_held.unionByName(tombs, allowMissingColumns=True), marked, keys, table.order).checkpoint()
            kept, dead = winners.filter(~F.col(GONE)).drop(GONE), winners.filter(GONE)
            if changes:
                changes(_signed(was_held.drop(GONE), kept))
    now = partition_values(kept, parts)
    touched = now + [v for v in was if v not in now]
    noted = index.note(spark, state, kept, dead.drop(AT), schema)
    if touched:
        if before_commit:
            before_commit(touched)
        rest = same_key(target.filter(in_partitions(touched)), keys_side, keys, "left_anti")
        at_risk = [v for v in was if v not in now]
        alive = partition_values(rest.filter(in_partitions(at_risk)), parts) if at_risk else []
        merged = rest.unionByName(clustered(kept, parts), allowMissingColumns=True).select(*schema.names)
        overwrite_partitions(merged, table.path, parts, gather=False)
        if not empty:
            empty_partitions(target, table.path, [v for v in at_risk if v not in alive])
    index.commit(spark, noted)
    return touched


def _signed(old: DataFrame | None, new: DataFrame) -> DataFrame:
    entering = new.withColumn(SIGN, F.lit(1))
    return entering if old is None else old.withColumn(SIGN, F.lit(-1)).unionByName(entering, allowMissingColumns=True)


def _key_range(fresh: DataFrame, keys: Sequence[str]) -> Column:
    """The span of the updates' keys as literals, which lets the scan skip row groups."""
    ends = fresh.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    keep = F.lit(True)
    for k in keys:
        keep = keep & (F.col(k).between(F.lit(ends[f"min_{k}"]), F.lit(ends[f"max_{k}"])) | F.col(k).isNull())
    return keep


def merge_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Column-wise MERGE: a value the new row leaves null keeps the old one; unmatched rows of both stay."""
    o = old.select(*[F.col(k).alias(f"__o_{k}") for k in keys], *[F.col(c).alias(f"__o_{c}") for c in columns])
    match: Column = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"__o_{k}"))
    return new.join(o, match, "full").select(
        *[F.coalesce(F.col(k), F.col(f"__o_{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(c), F.col(f"__o_{c}")).alias(c) for c in columns],
    )


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """The target after a log of I/U/D changes: the latest change per key counts, D removes the key."""
    last = latest(changes, keys, order)
    untouched = same_key(target, last, keys, "left_anti")
    alive = last.filter(~F.col(op).eqNullSafe(F.lit("D"))).select(*target.columns)
    return untouched.unionByName(alive)
