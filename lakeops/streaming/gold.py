"""Gold kept up to date from changes: what leaves Silver is taken off, what enters it is added.

A merge hands over the old and the new versions of its keys. They are kept in a folder per batch before Silver
is replaced, so a batch that is run again after a crash finds the changes of its first run, and not
the none that a merge into an already merged table would make. Gold's rows say which batch
they include last, so no batch counts twice, also where only some partitions were replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.money import from_minor, minor_units
from lakeops.operators.joins import broadcast_checked
from lakeops.operators.key_index import same_key
from lakeops.operators.layout import in_partitions, overwrite_partitions, partition_values, read_if_any, reused
from lakeops.operators.merge import SIGN
from lakeops.session import scratch_root

_STATE = {"n": "long", "units": "long", "counted": "long", "low": "double", "high": "double", "applied": "long"}
_DELTA = {"dn": "long", "dunits": "long", "dcounted": "long", "in_low": "double", "in_high": "double", "out_low": "double", "out_high": "double"}


@dataclass(frozen=True)
class ChangeGold:
    """Rows, total, average, least and greatest amount per group, in a table partitioned by some of the group's columns.

    Counts and sums (whole minor units) follow from the changes alone. Silver is read again only for groups
    whose least or greatest amount left without one beyond it entering, and only where their
    partition columns are. `prepare` makes a row's groups from a Silver row, for instance by a star
    join, and must give the same for the same row. Batches come in ascending order, one at a time.
    """

    path: str
    keys: Sequence[str]
    part_cols: Sequence[str]
    amount: str
    scale: int = 2
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def read(self, spark: SparkSession) -> DataFrame | None:
        """keys, txns, total_amount, avg_amount, min_amount, max_amount; None before the first batch."""
        state = read_if_any(spark, self.path)
        if state is None:
            return None
        counted = F.when(F.col("counted") > 0, F.col("counted"))
        return state.filter(F.col("n") > 0).select(
            *self.keys,
            F.col("n").alias("txns"),
            F.when(counted.isNotNull(), from_minor("units", self.scale)).alias("total_amount"),
            F.try_divide(F.col("units").cast("double"), counted.cast("double") * F.lit(float(10**self.scale))).alias("avg_amount"),
            F.col("low").alias("min_amount"),
            F.col("high").alias("max_amount"),
        )

    def start(self, spark: SparkSession, silver: Callable[[], DataFrame | None], batch_id: int) -> None:
        """Before a merge: Gold of a Silver table that had rows before Gold existed; made once."""
        files, ready = self._files(spark, f"{self.path}_ready")
        if files.exists(ready):
            return
        rows = silver()
        if rows is not None:
            delta = self._delta(rows.withColumn(SIGN, F.lit(1)))
            overwrite_partitions(self._first(delta, batch_id - 1), self.path, self.part_cols)
        files.create(ready, True).close()

    def keep(self, changes: DataFrame, batch_id: int) -> None:
        """Keep a batch's changes; those of its first run stay."""
        if not self._kept(changes.sparkSession, batch_id):
            changes.write.mode("overwrite").parquet(self._folder(batch_id))

    def apply(self, spark: SparkSession, batch_id: int, silver: Callable[[], DataFrame]) -> list[dict]:
        """Add a batch's kept changes; returns the partitions of Gold that were replaced."""
        if not self._kept(spark, batch_id):
            return []
        with reused(self._delta(spark.read.parquet(self._folder(batch_id)))) as delta:
            touched = partition_values(delta, self.part_cols)
            if touched:
                state = read_if_any(spark, self.path, self.part_cols, delta.schema)
                if state is None:
                    new = self._first(delta, batch_id)
                else:
                    new = self._added(state.filter(in_partitions(touched)), delta, batch_id, silver)
                overwrite_partitions(new, self.path, self.part_cols)
        self._forget(spark, batch_id)
        return touched

    def _delta(self, changes: DataFrame) -> DataFrame:
        rows = self.prepare(changes) if self.prepare else changes
        amount, sign = F.col(self.amount).cast("double"), F.col(SIGN)
        entering, leaving = F.when(sign > 0, amount), F.when(sign < 0, amount)
        aggregates = {
            "dn": F.sum(sign), "dunits": F.sum(sign * minor_units(amount, self.scale)), "dcounted": F.sum(F.when(amount.isNotNull(), sign)),
            "in_low": F.min(entering), "in_high": F.max(entering), "out_low": F.min(leaving), "out_high": F.max(leaving),
        }
        return rows.groupBy(*self.keys).agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) if n[0] == "d" else c.alias(n) for n, c in aggregates.items()])

    def _first(self, delta: DataFrame, batch_id: int) -> DataFrame:
        state = {"n": "dn", "units": "dunits", "counted": "dcounted", "low": "in_low", "high": "in_high"}
        return delta.select(*self.keys, *[F.col(d).alias(s) for s, d in state.items()], F.lit(batch_id).cast("long").alias("applied"))

    def _added(self, state: DataFrame, delta: DataFrame, batch_id: int, silver: Callable[[], DataFrame]) -> DataFrame:
        # One grouping in place of a full join: null keys are equal, and Gold is shuffled once.
        empty = [F.lit(None).cast(kind).alias(c) for c, kind in _DELTA.items()]
        blank = [F.lit(None).cast(kind).alias(c) for c, kind in _STATE.items()]
        both = state.select(*self.keys, *_STATE, *empty).unionByName(delta.select(*self.keys, *blank, *_DELTA))
        one = both.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in [*_STATE, *_DELTA]])
        # A group that the batch does not name, or that includes it already, stays as it is.
        due = F.col("dn").isNotNull() & (F.coalesce("applied", F.lit(-(2**62))) < F.lit(batch_id))

        def sum_of(s: str, d: str) -> Column:
            return F.coalesce(s, F.lit(0)) + F.when(due, F.col(d)).otherwise(F.lit(0))

        low_left = due & (F.col("out_low") <= F.col("low")) & ~F.coalesce(F.col("in_low") <= F.col("low"), F.lit(False))
        high_left = due & (F.col("out_high") >= F.col("high")) & ~F.coalesce(F.col("in_high") >= F.col("high"), F.lit(False))
        counted = sum_of("counted", "dcounted")
        some = counted > 0
        new = one.select(
            *self.keys,
            sum_of("n", "dn").alias("n"),
            sum_of("units", "dunits").alias("units"),
            counted.alias("counted"),
            F.when(some, F.when(due, F.least("low", "in_low")).otherwise(F.col("low"))).alias("low"),
            F.when(some, F.when(due, F.greatest("high", "in_high")).otherwise(F.col("high"))).alias("high"),
            F.when(due, F.lit(batch_id).cast("long")).otherwise(F.col("applied")).alias("applied"),
            (some & F.coalesce(low_left | high_left, F.lit(False))).alias("open"),
        )
        scratch_root(state.sparkSession)
        wrong = F.raise_error(F.lit(f"more rows leave a group of {self.path} than it has: it is not the Gold of this Silver"))
        new = new.withColumn("n", F.when(F.col("n") >= 0, F.col("n")).otherwise(wrong.cast("long"))).checkpoint()
        # A group without rows stays until the next batch, so that this one is not taken off again.
        new = new.filter((F.col("n") > 0) | (F.col("applied") == F.lit(batch_id)))
        left = new.filter("open").select(*self.keys)
        if left.take(1):
            rows = silver()
            rows = self.prepare(rows) if self.prepare else rows
            rows = rows.filter(in_partitions(partition_values(left, self.part_cols)))
            rows = same_key(rows, broadcast_checked(left), self.keys, "left_semi")
            found = rows.groupBy(*self.keys).agg(F.min(F.col(self.amount).cast("double")).alias("low"), F.max(F.col(self.amount).cast("double")).alias("high"))
            again = new.filter("open").drop("low", "high").alias("g")
            match = reduce(lambda a, b: a & b, [F.col(f"g.{k}").eqNullSafe(F.col(f"f.{k}")) for k in self.keys])
            again = again.join(found.alias("f"), match, "left").select("g.*", "f.low", "f.high")
            new = new.filter(~F.col("open")).unionByName(again)
        return new.drop("open")

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}_changes/batch={batch_id}"

    def _kept(self, spark: SparkSession, batch_id: int) -> bool:
        files, path = self._files(spark, f"{self._folder(batch_id)}/_SUCCESS")
        return files.exists(path)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Changes of earlier batches go; no batch before this one is run again."""
        files, root = self._files(spark, f"{self.path}_changes")
        for f in files.listStatus(root):
            if int(f.getPath().getName().split("=")[1]) < batch_id:
                files.delete(f.getPath(), True)

    def _files(self, spark: SparkSession, path: str):
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(spark._jsc.hadoopConfiguration()), there
