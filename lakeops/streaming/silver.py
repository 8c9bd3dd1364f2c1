"""Micro-batch sinks: Silver upsert, raw-and-clean fan-out, change capture, Gold refresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.nested import row_hash
from lakeops.operators.governance import Run, batch_done, job_run, snapshot_schema
from lakeops.operators.layout import in_partitions, partition_values, refresh_partitions, reused
from lakeops.operators.merge import Keyed, merge_partitions
from lakeops.operators.quality import quarantine, rule_metrics, split_rules
from lakeops.streaming.gold import ChangeGold


@dataclass(frozen=True)
class Upsert:
    """A Silver table kept up to date from micro-batches.

    `normalise` runs on each batch first. `gold` is called with the touched partition
    values after the merge. `deleted` marks rows that remove their key. With a `run_log`,
    the partitions a batch is about to touch are noted beside it: a batch that is run
    again after a crash finds its keys already moved, and Gold has to be refreshed where
    they came from as well. `change_gold` is kept up to date from the changes of each batch instead.
    """

    table: Keyed
    rules: dict[str, Column]
    job_name: str = "silver_upsert"
    source: str = ""
    run_log: str | None = None
    registry: str | None = None
    quarantine_path: str | None = None
    normalise: Callable[[DataFrame], DataFrame] | None = None
    key_stays_in_partition: bool = False
    deleted: Column | None = None
    gold: Callable[[DataFrame, Sequence[dict]], None] | None = None
    change_gold: ChangeGold | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.run_log is None:
            self._apply(batch, batch_id, Run(self.job_name, self.source, self.table.path, batch_id))
            return
        # The merge is idempotent; the ledger only keeps a replayed batch out of the log
        # and the quarantine a second time.
        if batch_done(spark, self.run_log, self.job_name, batch_id):
            return
        with job_run(spark, self.run_log, self.job_name, self.source, self.table.path, batch_id) as run:
            self._apply(batch, batch_id, run)
        # The log says from now on that nothing is left to do for the batch.
        notes = spark._jvm.org.apache.hadoop.fs.Path(self._notes(batch_id))
        notes.getFileSystem(spark._jsc.hadoopConfiguration()).delete(notes, True)

    def _notes(self, batch_id: int) -> str:
        return f"{self.run_log}_touched/job={self.job_name}/batch={batch_id}"

    def _apply(self, batch: DataFrame, batch_id: int, run: Run) -> None:
        spark = batch.sparkSession
        df = self.normalise(batch) if self.normalise else batch
        with reused(df) as rows:
            counts = rule_metrics(rows, self.rules).first()
            run.input_rows, run.dq_failed_rows = counts["input_rows"], counts["dq_failed_rows"]
            good, bad = split_rules(rows, self.rules)
            if counts["dq_failed_rows"] and self.quarantine_path:
                quarantine(bad, f"{self.quarantine_path}/batch_id={batch_id}", run.run_id or str(batch_id), "overwrite")
            run.output_rows = counts["good_rows"]
            if not counts["good_rows"]:
                return
            note, notes = None, self._notes(batch_id)
            if self.gold and self.run_log:
                parts = StructType([good.schema[c] for c in self.table.part_cols])
                note = partial(_note_touched, spark, notes, parts)
            changes = None
            if self.change_gold:
                self.change_gold.start(spark, lambda: self.table.read(spark, df.schema), batch_id)
                changes = partial(self.change_gold.keep, batch_id=batch_id)
            touched = merge_partitions(spark, self.table, good, self.key_stays_in_partition, self.deleted, note, changes)
            if note:
                noted = partition_values(spark.read.parquet(notes), self.table.part_cols)
                touched += [v for v in noted if v not in touched]
            if self.registry:
                snapshot_schema(spark, good.schema, self.job_name, self.table.path, self.registry)
        if self.change_gold:
            self.change_gold.apply(spark, batch_id, lambda: self.table.read(spark, df.schema))
        if self.gold and touched:
            self.gold(self.table.read(spark, df.schema).filter(in_partitions(touched)), touched)


def _note_touched(spark: SparkSession, path: str, schema: StructType, touched: list[dict]) -> None:
    rows = spark.createDataFrame([tuple(v[c] for c in schema.fieldNames()) for v in touched], schema)
    rows.coalesce(1).write.mode("append").parquet(path)


def gold_refresh(path: str, partition_by: Sequence[str], aggregate: Callable[[DataFrame], DataFrame]):
    """Recompute Gold for the partitions a batch touched and replace just those.

    The Silver frame arrives limited to those partitions, so the scan is pruned. A
    partition that Silver no longer has rows for ends up empty in Gold.
    """

    def refresh(silver: DataFrame, touched: Sequence[dict]) -> None:
        refresh_partitions(aggregate(silver), path, partition_by, touched)

    return refresh


def raw_and_clean(
    raw_path: str, sink: Callable[[DataFrame, int], None], hash_columns: list[str], partition_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """One parsed batch, two tables: raw rows with an event hash, and the Silver sink.

    The batch is read once. Raw rows go to a folder per batch id, so a replay replaces
    its own rows instead of adding them again.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        with reused(batch) as rows:
            hashed = rows.withColumn("event_hash", row_hash(hash_columns))
            (
                hashed.withColumn("batch_id", F.lit(batch_id).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id", *partition_by)
                .parquet(raw_path)
            )
            sink(rows, batch_id)

    return both
