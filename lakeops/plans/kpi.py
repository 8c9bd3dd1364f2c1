"""Batch KPI jobs: enrichment, daily and star-schema KPIs, governed publishing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.conditional import amount_bucket
from lakeops.functions.money import exact_sum
from lakeops.operators.aggregate import kpi, sum_where
from lakeops.operators.governance import job_run, snapshot_schema
from lakeops.operators.joins import Dim, broadcast_checked, join_as, star_join
from lakeops.operators.layout import in_partitions, publish_day, read_if_any, refresh_partitions
from lakeops.operators.merge import Keyed, merge_partitions
from lakeops.operators.quality import reconcile
from lakeops.operators.skew import salted_totals
from lakeops.operators.windows import top_n
from lakeops.session import scratch_path
from lakeops.streaming.gold import ChangeGold


def enrich(fact: DataFrame, dims: Sequence[Dim], ts: str, amount: str) -> DataFrame:
    """Fact with dimension attributes, the amount band and the day."""
    return star_join(fact, dims).withColumns({"amount_bucket": amount_bucket(amount), "dt": F.to_date(ts)})


def period_kpi(
    fact: DataFrame, dim: Dim, period: Column, keys: Sequence[str], amount: str, strategy: str = "broadcast", scale: int | None = 2
) -> DataFrame:
    """Prune the fact to the period, join one dimension, then KPI per group, sorted by group."""
    slim = fact.filter(period)
    return kpi(star_join(slim, [dim], strategy), keys, amount, scale).orderBy(*keys)


def star_kpi(fact: DataFrame, dims: Sequence[Dim], keys: Sequence[str], amount: str, strategy: str = "broadcast") -> DataFrame:
    return kpi(star_join(fact, dims, strategy), keys, amount)


def governed_day(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    day,
    dims: Sequence[Dim],
    keys: Sequence[str],
    amount: str,
    log_path: str,
    registry: str,
    part_col: str = "dt",
) -> DataFrame:
    """Read one day of Silver, compute its KPI, publish it, log the run, check what was written.

    Returns the reconciliation; a disagreement fails the run and is logged as such. The day is read
    once: its rows and total are observed in the pass that computes the KPI, which is kept
    in a scratch table. Only where they disagree with what was published, which a task that ran
    twice may cause as well, is the day counted again.
    """
    # The partition column is of the day's own type, whatever the folders' names look like.
    types = spark.range(1).select(F.lit(day).alias(part_col)).schema
    with job_run(spark, log_path, "gold_kpi_daily", silver_path, gold_path) as run:
        fact = read_if_any(spark, silver_path, [part_col], types).filter(F.col(part_col) == F.lit(day))
        totals = [F.count(F.lit(1)).alias("t"), exact_sum(amount).alias("a")]
        needed = {part_col, amount, *keys, *[d.fact_key for d in dims]}
        seen, kept = Observation(), scratch_path(spark, "governed-day")
        watched = fact.select(*[c for c in fact.columns if c in needed]).observe(seen, *totals)
        star_kpi(watched, dims, [part_col, *keys], amount).write.parquet(kept)
        result = spark.read.parquet(kept)
        publish_day(result, gold_path, part_col, day)
        published = read_if_any(spark, gold_path, [part_col], types).filter(F.col(part_col) == F.lit(day))
        snapshot_schema(spark, published.schema, "gold.kpi_daily", gold_path, registry)
        counts = published.agg(F.count(F.lit(1)).alias("n"), F.sum("txns").alias("t"), exact_sum("total_amount").alias("a")).first()
        source, target = seen.get, (counts["t"] or 0, counts["a"])
        if (source["t"], source["a"]) != target:
            source = fact.agg(*totals).first()
        run.input_rows, run.output_rows = source["t"], counts["n"]
        if (source["t"], source["a"]) != target:
            raise RuntimeError(f"published totals differ: {source} and {counts}")
    return reconcile(
        result, published, [part_col, *keys], {"txns": F.sum("txns"), "total_amount": exact_sum("total_amount")}
    )


def late_data(
    spark: SparkSession, silver: Keyed, updates: DataFrame, gold_path: str, dims: Sequence[Dim], keys: Sequence[str], amount: str
) -> list[dict]:
    """Merge a late batch into Silver and rebuild Gold for the partitions it touched."""
    touched = merge_partitions(spark, silver, updates)
    if touched:
        changed = silver.read(spark, updates.schema).filter(in_partitions(touched))
        result = star_kpi(changed, dims, [*silver.part_cols, *keys], amount)
        refresh_partitions(result, gold_path, list(silver.part_cols), touched)
    return touched


def late_data_changes(spark: SparkSession, silver: Keyed, updates: DataFrame, gold: ChangeGold, batch_id: int) -> list[dict]:
    """Merge a late batch into Silver and add its changes to Gold, without reading the touched partitions again.

    A run that is repeated, after a crash too, has to come with the same batch id.
    """

    def whole() -> DataFrame | None:
        return silver.read(spark, updates.schema)

    gold.start(spark, whole, batch_id)
    touched = merge_partitions(spark, silver, updates, changes=partial(gold.keep, batch_id=batch_id))
    gold.apply(spark, batch_id, whole)
    return touched


def skewed_segment_kpi(
    fact: DataFrame, dim: DataFrame, key: str, segment: str, amount: str, row_key: Sequence[str], n: int | None = None
) -> DataFrame:
    """Salted total per customer, then the dimension joined to one row per customer, then totals per segment."""
    totals = salted_totals(fact, [key], amount, row_key, n)
    sides = join_as(totals, broadcast_checked(dim.select(key, segment)), key, "left")
    return sides.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_customers"), F.sum("n_rows").alias("txns"), exact_sum("total").alias("total_amount")
    )


def daily_revenue(df: DataFrame, ts: str, amount: str, success: Column) -> DataFrame:
    """Rows, successful rows and revenue of successful rows per day."""
    return (
        df.groupBy(F.to_date(ts).alias("dt"))
        .agg(
            F.count(F.lit(1)).alias("txns"),
            F.count_if(success).alias("success_txns"),
            sum_where(success, amount).alias("revenue"),
        )
    )


def top_customers(df: DataFrame, ts: str, customer: str, amount: str, n: int = 10) -> DataFrame:
    """Customers whose daily revenue has dense rank at most n on that day."""
    daily = df.groupBy(F.to_date(ts).alias("dt"), customer).agg(exact_sum(amount).alias("revenue"))
    return top_n(daily, ["dt"], ["-revenue"], n, "dense_rank", "revenue_rank")
