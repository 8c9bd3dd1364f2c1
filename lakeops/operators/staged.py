"""Publishing by switching: rows are written beside the table, then the catalog points to them.

A partition is served from one of its versions, a folder each. A new version is complete before the catalog names it, so readers see
the old rows or the new ones, and a crash in between leaves the old ones. The version before stays
as a backup until it expires.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.layout import as_type, in_partitions, write_table

_SERVED = "_SERVED"


@dataclass(frozen=True)
class StagedTable:
    """A catalog table over versions of its partitions under `root`. One writer at a time.

    Each partition is switched by one step of the catalog. Several partitions are switched one after the other: a key that moves
    may be seen in both or in none in between.
    """

    name: str
    root: str
    schema: StructType
    part_cols: Sequence[str]

    def create(self, spark: SparkSession) -> StagedTable:
        parts = ", ".join(f"`{c}`" for c in self.part_cols)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.schema.toDDL()}) USING parquet PARTITIONED BY ({parts}) LOCATION '{_quoted(self.root)}'")
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).select(*self.schema.names)

    def stage(self, df: DataFrame, values: Sequence[dict]) -> int:
        """Write the rows of the given partitions as a new version that no reader sees; returns its number."""
        spark = df.sparkSession
        version = max(self.versions(spark, complete=False), default=0) + 1
        wanted = [{c: as_type(v[c], self.schema[c].dataType) for c in self.part_cols} for v in values]
        rows = df.select(*[F.col(c).cast(self.schema[c].dataType) for c in self.schema.names]).filter(in_partitions(wanted))
        write_table(rows, f"{self.root}/v={version}", "errorifexists", self.part_cols)
        return version

    def switch(self, spark: SparkSession, version: int, values: Sequence[dict]) -> None:
        """Serve the given partitions from a version; one without rows there is empty."""
        if version not in self.versions(spark):
            raise ValueError(f"version {version} of {self.name} is not complete")
        files, _ = self._files(spark)
        for v in values:
            place = self._place(spark, version, v)
            files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(place))
            self._point(spark, v, place)
            # Only versions that were served, and not withdrawn since, are backups.
            files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{_SERVED}"), True).close()

    def publish(self, df: DataFrame, values: Sequence[dict]) -> int:
        """Replace the given partitions by what the frame, which may read the table itself, holds for them."""
        version = self.stage(df, values)
        self.switch(df.sparkSession, version, values)
        return version

    def restore(self, spark: SparkSession, values: Sequence[dict]) -> None:
        """Serve the given partitions from the version before the present one; a partition without one goes."""
        files, _ = self._files(spark)
        for v in values:
            now, before = self.version_of(spark, v), self.backups(spark, v)
            if now is None:
                raise ValueError(f"{self.name} has no partition {v}")
            if before:
                self._point(spark, v, self._place(spark, before[0], v))
            else:
                spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self._spec(v)})")
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self._place(spark, now, v)}/{_SERVED}"), False)

    def versions(self, spark: SparkSession, complete: bool = True) -> list[int]:
        files, root = self._files(spark)
        if not files.exists(root):
            return []
        found = [f.getPath() for f in files.listStatus(root) if f.getPath().getName().startswith("v=")]
        done = spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(p.getName()[2:]) for p in found if not complete or files.exists(done(p, "_SUCCESS")))

    def version_of(self, spark: SparkSession, value: dict) -> int | None:
        """The version that a partition is served from."""
        if not spark.sql(f"SHOW PARTITIONS {self.name} PARTITION ({self._spec(value)})").take(1):
            return None
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} PARTITION ({self._spec(value)})").filter("col_name = 'Location'")
        return int(rows.first()["data_type"].rsplit("/v=", 1)[1].split("/")[0])

    def backups(self, spark: SparkSession, value: dict) -> list[int]:
        """Versions that a partition was served from before the present one, newest first."""
        files, _ = self._files(spark)
        now = self.version_of(spark, value)
        older = [n for n in self.versions(spark) if now is not None and n < now]
        return [n for n in reversed(older) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{self._place(spark, n, value)}/{_SERVED}"))]

    def expire(self, spark: SparkSession, values: Sequence[dict], keep: int = 1) -> None:
        """Remove all but the newest `keep` backups of the given partitions."""
        files, _ = self._files(spark)
        for v in values:
            for n in self.backups(spark, v)[keep:]:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(self._place(spark, n, v)), True)

    def _point(self, spark: SparkSession, value: dict, place: str) -> None:
        spec = self._spec(value)
        if self.version_of(spark, value) is None:
            spark.sql(f"ALTER TABLE {self.name} ADD PARTITION ({spec}) LOCATION '{_quoted(place)}'")
        else:
            spark.sql(f"ALTER TABLE {self.name} PARTITION ({spec}) SET LOCATION '{_quoted(place)}'")

    def _spec(self, value: dict) -> str:
        return ", ".join(f"`{c}` = " + ("null" if value[c] is None else f"'{_quoted(str(value[c]))}'") for c in self.part_cols)

    def _place(self, spark: SparkSession, version: int, value: dict) -> str:
        path = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join([f"{self.root}/v={version}", *[path(c, None if value[c] is None else str(value[c])) for c in self.part_cols]])

    def _files(self, spark: SparkSession):
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
