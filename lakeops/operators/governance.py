"""Run log, schema registry and table lineage."""

from __future__ import annotations

import subprocess
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.hierarchy import closure
from lakeops.operators.layout import read_if_any
from lakeops.schemas import JOB_RUNS, SCHEMA_REGISTRY


@cache
def git_commit() -> str:
    """Of the working copy that the driver runs in; asked for once."""
    try:
        run = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, timeout=5)
        return run.stdout.strip() or "unknown"
    except (OSError, subprocess.SubprocessError):
        return "unknown"


@dataclass
class Run:
    """What a job reports about itself; filled in while it runs."""

    job_name: str
    source_path: str
    target_path: str
    batch_id: int | None = None
    run_id: str = ""
    input_rows: int | None = None
    output_rows: int | None = None
    dq_failed_rows: int | None = None


def log_run(spark: SparkSession, path: str, run: Run, status: str, error: str = "", now: datetime | None = None) -> None:
    row = (
        run.run_id, run.job_name, run.batch_id, git_commit(), run.source_path, run.target_path,
        run.input_rows, run.output_rows, run.dq_failed_rows, status, error, now or datetime.now(timezone.utc),
    )
    rows = spark.createDataFrame([row], JOB_RUNS).coalesce(1)
    rows.write.mode("append").partitionBy("job_name", "batch_id").parquet(path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The whole log."""
    return spark.read.schema(JOB_RUNS).parquet(path).select(*JOB_RUNS.fieldNames())


@contextmanager
def job_run(
    spark: SparkSession, log_path: str, job_name: str, source: str, target: str, batch_id: int | None = None
) -> Iterator[Run]:
    """Log the run whether it succeeds or fails; a failure is raised again."""
    run = Run(job_name, source, target, batch_id, run_id=uuid.uuid4().hex)
    try:
        yield run
    except BaseException as e:
        log_run(spark, log_path, run, "FAILED", f"{type(e).__name__}: {e}")
        raise
    log_run(spark, log_path, run, "SUCCESS")


def batch_done(spark: SparkSession, log_path: str, job_name: str, batch_id: int) -> bool:
    """Whether a stream's batch is already logged as successful; only the batch's folder of the log is read."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(job_name)
    log = read_if_any(spark, f"{log_path}/job_name={name}/batch_id={batch_id}")
    return log is not None and bool(log.filter(F.col("status") == "SUCCESS").take(1))


def snapshot_schema(spark: SparkSession, schema: StructType, name: str, dataset_path: str, registry: str) -> bool:
    """Record a dataset's schema if it differs from its last snapshot; says whether it did."""
    text = schema.json()
    snap = spark.createDataFrame([(name, dataset_path, text, None, datetime.now(timezone.utc))], SCHEMA_REGISTRY)
    snap = snap.withColumn("schema_hash", F.sha2("schema_json", 256))
    known = read_if_any(spark, registry)
    if known is not None:
        last = known.filter(F.col("dataset_name") == name).orderBy(F.desc("snap_at")).select("schema_json").take(1)
        if last and last[0]["schema_json"] == text:
            return False
    snap.coalesce(1).write.mode("append").parquet(registry)
    return True


def lineage(runs: DataFrame, tables: Sequence[str] | None = None) -> DataFrame:
    """(source, target, hops): every table reachable from the named tables, by the successful runs.

    Without names from every table, which is a row for each pair: for small graphs.
    """
    edges = runs.filter(F.col("status") == "SUCCESS").select("source_path", "target_path")
    return closure(edges, "source_path", "target_path", tables)
