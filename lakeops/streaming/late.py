"""Late rows kept aside: a watermark in the sink's own hand, so that no row is dropped unseen."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.layout import read_if_any, reused

DELAY = "late_by_seconds"
#: Notes of batches before the last ones go; a batch is only ever repeated right after itself.
_KEPT = 16


@dataclass(frozen=True)
class LateSplit:
    """Rows of a micro-batch behind the watermark go to `quarantine_path`, all others to `sink`.

    The watermark of a batch is the greatest event time of the batches before it, less `delay_seconds`:
    a row before it is late. Whatever the micro-batches, each row goes to one of the two sides. Rows without an event time
    are not late: rules deal with those. Late rows carry by how many seconds they missed the watermark. They go to a
    folder per batch, so a batch that comes again replaces its own rows; its watermark is the same then, as
    `notes_path` has the greatest event time up to each batch. The sink has to stand repeated batches, as ever. `notes_path` and `quarantine_path` belong to one query with one checkpoint.
    """

    event_ts: str
    delay_seconds: int
    notes_path: str
    quarantine_path: str
    sink: Callable[[DataFrame, int], None]

    def watermark(self, spark: SparkSession, batch_id: int):
        """Of a batch, as a column; null before the first one."""
        greatest = self._greatest_before(spark, batch_id)
        return F.lit(greatest).cast("timestamp") - F.make_interval(secs=F.lit(self.delay_seconds))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, F.col(self.event_ts).cast("timestamp")
        mark = self.watermark(spark, batch_id)
        late = F.coalesce(time < mark, F.lit(False))
        with reused(batch) as rows:
            missed = (F.unix_micros(mark) - F.unix_micros(time)) / F.lit(1_000_000.0)
            aside = rows.filter(late).withColumn(DELAY, missed)
            aside.write.mode("overwrite").parquet(f"{self.quarantine_path}/batch_id={batch_id}")
            self.sink(rows.filter(~late), batch_id)
            # Text keeps a time of any zone and year as it is.
            last = rows.agg(F.max(time).alias("t")).select(F.greatest("t", F.lit(self._greatest_before(spark, batch_id)).cast("timestamp")).alias("t"))
            last.select(F.col("t").cast("string").alias("greatest")).coalesce(1).write.mode("overwrite").parquet(f"{self.notes_path}/batch_id={batch_id}")
        self._forget(spark, batch_id)

    def late_rows(self, spark: SparkSession) -> DataFrame | None:
        """All rows kept aside, with their batch; None before the first batch."""
        return read_if_any(spark, self.quarantine_path)

    def _greatest_before(self, spark: SparkSession, batch_id: int) -> str | None:
        earlier = [b for b in self._batches(spark) if b < batch_id]
        if not earlier:
            return None
        return spark.read.schema("greatest string").parquet(f"{self.notes_path}/batch_id={max(earlier)}").first()["greatest"]

    def _batches(self, spark: SparkSession) -> list[int]:
        """Batches with a whole note."""
        place = spark._jvm.org.apache.hadoop.fs.Path
        files = place(self.notes_path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(place(f"{self.notes_path}/batch_id=*/_SUCCESS")) or []
        return [int(f.getPath().getParent().getName().split("=")[1]) for f in found]

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path
        files = place(self.notes_path).getFileSystem(spark._jsc.hadoopConfiguration())
        for old in [b for b in self._batches(spark) if b < batch_id - _KEPT]:
            files.delete(place(f"{self.notes_path}/batch_id={old}"), True)
