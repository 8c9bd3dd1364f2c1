"""Where each key of a partitioned table is, kept beside the table and committed with its merges.

The index is a log of Parquet versions, each bucketed by a hash of the key: a merge appends the keys
of its batch, so what it writes and the buckets it reads follow the batch and not the table. Deleted
keys stay as tombstones with the order values of their delete, for a stated time.

A merge notes a version before it replaces partitions and commits it afterwards. Entries of a
version that was never committed do not replace older ones but stand beside them: a key is
looked for wherever it may be. So neither a replay nor the next batch after a crash misses a row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.joins import broadcast_checked

GONE, AT, BUCKET, VERSION = "__gone", "__at", "__bucket", "__version"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join by keys, nulls being equal."""
    side = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return left.join(side, match, how)


@dataclass(frozen=True)
class State:
    """One manifest: the versions with whether each is committed, and the table's schema."""

    number: int
    buckets: int
    schema: StructType
    versions: tuple[tuple[int, bool], ...]

    @property
    def next(self) -> int:
        return max((v for v, _ in self.versions), default=0) + 1


@dataclass(frozen=True)
class KeyIndex:
    """An index of a table with the given keys, partition columns and order columns.

    `rows_per_bucket` sets the number of buckets when the index is built; after
    `compact_after` versions they are written together, and tombstones older than
    `keep_deleted` go: an older version of a key that arrives later than this counts as new. One
    writer at a time.
    """

    path: str
    keys: tuple[str, ...]
    part_cols: tuple[str, ...]
    order: tuple[str, ...]
    rows_per_bucket: int = 1_000_000
    least_buckets: int = 16
    compact_after: int = 16
    keep_deleted: timedelta = timedelta(days=30)
    now: Callable[[], datetime] = _now

    # The manifest.

    def _files(self, spark: SparkSession):
        paths = spark._jvm.org.apache.hadoop.fs
        return paths, paths.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifests(self, spark: SparkSession) -> list[int]:
        paths, files = self._files(spark)
        folder = paths.Path(f"{self.path}/manifest")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def state(self, spark: SparkSession) -> State | None:
        """The newest manifest, or None before the index is built."""
        numbers = self._manifests(spark)
        if not numbers:
            return None
        paths, files = self._files(spark)
        stream = files.open(paths.Path(f"{self.path}/manifest/{numbers[-1]}.json"))
        try:
            said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        versions = tuple((v, done) for v, done in said["versions"])
        return State(numbers[-1], said["buckets"], StructType.fromJson(said["schema"]), versions)

    def _say(self, spark: SparkSession, state: State) -> None:
        """A manifest appears whole, by a rename; those before the last are not needed any more."""
        paths, files = self._files(spark)
        text = json.dumps({"buckets": state.buckets, "schema": state.schema.jsonValue(), "versions": list(state.versions)})
        hidden, shown = (paths.Path(f"{self.path}/manifest/{name}") for name in (f".{state.number}.tmp", f"{state.number}.json"))
        stream = files.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not files.rename(hidden, shown):
            raise RuntimeError(f"{shown} is there already: two writers on one index")
        for old in self._manifests(spark)[:-2]:
            files.delete(paths.Path(f"{self.path}/manifest/{old}.json"), False)

    # Entries.

    def _bucket(self, buckets: int) -> Column:
        # As text, so that a key has the same bucket whatever whole-number type a batch gives it.
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(buckets)).cast("int")

    def _schema(self, schema: StructType) -> StructType:
        out = StructType()
        for c in dict.fromkeys([*self.keys, *self.part_cols, *self.order]):
            out.add(c, schema[c].dataType)
        return out.add(GONE, "boolean").add(AT, "timestamp")

    def _write(self, spark: SparkSession, entries: DataFrame, schema: StructType, buckets: int, version: int) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema(schema)]
        rows = entries.select(*columns, self._bucket(buckets).alias(BUCKET)).hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{VERSION}={version}")

    def _read(self, spark: SparkSession, state: State) -> DataFrame:
        schema = self._schema(state.schema).add(BUCKET, "integer").add(VERSION, "long")
        folders = [f"{self.path}/{VERSION}={v}" for v, _ in state.versions]
        return spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def _standing(self, entries: DataFrame, state: State) -> DataFrame:
        """Of each key its newest committed entry and all that came after it."""
        done = [v for v, committed in state.versions if committed]
        newest = F.max(F.when(F.col(VERSION).isin(done), F.col(VERSION))).over(Window.partitionBy(*self.keys))
        return entries.withColumn("__newest", newest).filter(F.coalesce(F.col(VERSION) >= F.col("__newest"), F.lit(True))).drop("__newest")

    def lookup(self, spark: SparkSession, state: State, wanted: DataFrame) -> DataFrame:
        """Entries of the wanted keys, from their buckets only."""
        # At most the number of buckets.
        buckets = [r["b"] for r in wanted.select(self._bucket(state.buckets).alias("b")).distinct().collect()]
        entries = self._read(spark, state).filter(F.col(BUCKET).isin(buckets))
        found = same_key(entries, broadcast_checked(wanted.select(*self.keys)), self.keys, "left_semi")
        return self._standing(found, state).drop(BUCKET, VERSION)

    # Life.

    def build(self, spark: SparkSession, table: DataFrame | None, schema: StructType) -> State:
        """A new index of all rows of the table, the one scan of its keys; tombstones are not known to it."""
        numbers, count = self._manifests(spark), 0
        if table is not None:
            count = table.count()
        buckets = self.least_buckets
        while buckets * self.rows_per_bucket < count:
            buckets *= 2
        number = (numbers[-1] if numbers else 0) + 1
        # Above every version that an earlier index may have left.
        versions: tuple[tuple[int, bool], ...] = ()
        if table is not None:
            missing = [c for c in self.order if c not in (*self.keys, *self.part_cols)]
            entries = table.select(*self.keys, *[c for c in self.part_cols if c not in self.keys], *[F.col(c) for c in missing])
            version = 1_000_000 * number
            self._write(spark, entries.withColumns({GONE: F.lit(False), AT: F.lit(None).cast("timestamp")}), schema, buckets, version)
            versions = ((version, True),)
        state = State(number, buckets, schema, versions)
        self._say(spark, state)
        return state

    def note(self, spark: SparkSession, state: State, alive: DataFrame, gone: DataFrame, schema: StructType) -> State:
        """Write down where the batch's keys are about to be; `gone` become tombstones."""
        at = F.lit(self.now()).cast("timestamp")
        columns = list(dict.fromkeys([*self.keys, *self.part_cols, *self.order]))
        entries = alive.select(*columns).withColumns({GONE: F.lit(False), AT: F.lit(None).cast("timestamp")})
        entries = entries.unionByName(gone.select(*columns).withColumns({GONE: F.lit(True), AT: at}))
        version = state.next
        self._write(spark, entries, schema, state.buckets, version)
        noted = State(state.number + 1, state.buckets, schema, (*state.versions, (version, False)))
        self._say(spark, noted)
        return noted

    def commit(self, spark: SparkSession, noted: State) -> State:
        """The noted version is true now; many versions become one."""
        *before, (version, _) = noted.versions
        state = State(noted.number + 1, noted.buckets, noted.schema, (*before, (version, True)))
        self._say(spark, state)
        return self.compact(spark, state) if len(state.versions) > self.compact_after else state

    def compact(self, spark: SparkSession, state: State) -> State:
        """All versions as one: what stands of every key, without tombstones whose time is over."""
        standing = self._standing(self._read(spark, state), state)
        over = F.col(GONE) & (F.col(AT) < F.lit(self.now() - self.keep_deleted).cast("timestamp"))
        version = state.next
        self._write(spark, standing.filter(~F.coalesce(over, F.lit(False))), state.schema, state.buckets, version)
        small = State(state.number + 1, state.buckets, state.schema, ((version, True),))
        self._say(spark, small)
        paths, files = self._files(spark)
        for v, _ in state.versions:
            files.delete(paths.Path(f"{self.path}/{VERSION}={v}"), True)
        return small
