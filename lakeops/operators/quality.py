"""Data quality: rule split, metrics, quarantine, reconciliation, schema drift."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.nested import stable_hash

FAILED = "failed_rules"


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c}_not_null": F.col(c).isNotNull() for c in columns}


def positive_rule(column: str) -> dict[str, Column]:
    """Present, a number, and above zero."""
    c = F.col(column)
    return {f"{column}_positive": c.isNotNull() & ~F.isnan(c) & (c > 0)}


def _all_hold(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def _fails(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def split_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad); a rule that is null counts as failed, and bad rows name the rules they fail.

    Both are plain filters on the input: exact copies of good rows stay, and the rules on
    raw columns reach the scan.
    """
    names = [F.when(_fails(ok), F.lit(name)) for name, ok in rules.items()]
    bad = df.filter(_fails(_all_hold(rules))).withColumn(FAILED, F.array_compact(F.array(*names)))
    return df.filter(_all_hold(rules)), bad


def _metrics(rules: dict[str, Column]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(_all_hold(rules)).alias("good_rows"),
        F.count_if(_fails(_all_hold(rules))).alias("dq_failed_rows"),
        *[F.count_if(_fails(ok)).alias(f"failed_{name}") for name, ok in rules.items()],
    ]


def rule_metrics(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: input, good and failed rows and the failures of each rule, in one pass."""
    return df.agg(*_metrics(rules))


def observed_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame, and the metrics of `rule_metrics` taken by the first action that reads all of it.

    A task that runs again after a lost executor is counted again, so observed counts are a
    report; to decide by them, compare them with what was written and count once more if they differ.
    """
    seen = Observation()
    return df.observe(seen, *_metrics(rules)), seen


def quarantine(bad: DataFrame, path: str, run_id: str, mode: str = "append") -> str:
    """Write failed rows with the run that refused them; a folder per run may be overwritten."""
    bad.withColumn("run_id", F.lit(run_id)).write.mode(mode).parquet(path)
    return path


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """One row per check with the value on both sides and whether they agree.

    `measures` maps a name to an aggregate.
    """

    def totals(df: DataFrame, side: str) -> DataFrame:
        row = df.agg(F.count(F.lit(1)).cast("double").alias("rows"), *[c.cast("double").alias(n) for n, c in measures.items()])
        return row.unpivot([], [F.col(c) for c in ("rows", *measures)], "check", side)

    def keyed(df: DataFrame, in_source: bool) -> DataFrame:
        return df.select(*keys, F.lit(in_source).alias("__s"))

    # Both sides in one aggregate: one exchange of key counts, null keys included.
    per_key = (
        keyed(source, True)
        .unionByName(keyed(target, False))
        .groupBy(*keys)
        .agg(F.count_if("__s").alias("__s"), F.count_if(~F.col("__s")).alias("__t"))
    )
    totals_by_key = per_key.agg(
        F.count_if(F.col("__s") > 1).cast("double").alias("dup_s"),
        F.count_if(F.col("__t") > 1).cast("double").alias("dup_t"),
        F.count_if(F.col("__t") == 0).cast("double").alias("lost"),
        F.count_if(F.col("__s") == 0).cast("double").alias("extra"),
    )

    def check(name: str, on_source: Column, on_target: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), on_source.alias("source_value"), on_target.alias("target_value"))

    none = F.lit(0.0)
    keyed_rows = totals_by_key.select(
        F.inline(
            F.array(
                check("duplicate_keys", F.col("dup_s"), F.col("dup_t")),
                check("missing_keys", none, F.col("lost")),
                check("unexpected_keys", none, F.col("extra")),
            )
        )
    )
    both = totals(source, "source_value").join(F.broadcast(totals(target, "target_value")), "check")
    return both.unionByName(keyed_rows).withColumn("ok", F.col("source_value").eqNullSafe(F.col("target_value")))


def _signed(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows of both sides as (keys, __bucket, __side, __high, __low), the halves of a row's hash being positive or negative by side."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        df = df.select(*source.columns)
        # Hashes pass over nulls, so which columns are null is hashed as well.
        row = F.xxhash64(stable_hash(df), *[F.col(f"`{c}`").isNull() for c in df.columns])
        bucket = F.pmod(F.xxhash64(*keys, *[F.col(f"`{k}`").isNull() for k in keys]), F.lit(buckets))
        high, low = F.shiftrightunsigned("__hash", 32) * sign, F.col("__hash").bitwiseAND(F.lit(0xFFFFFFFF)) * sign
        marked = df.select(*keys, bucket.alias("__bucket"), row.alias("__hash"), F.lit(sign).alias("__side"))
        return marked.select(*keys, "__bucket", "__side", high.alias("__high"), low.alias("__low"))

    return side(source, 1).unionByName(side(target, -1))


def _differs() -> Column:
    return (F.sum("__side") != 0) | (F.sum("__high") != 0) | (F.sum("__low") != 0)


def changed_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = 65_536) -> DataFrame:
    """(keys, change, source_rows, target_rows): the keys whose rows are not the same on both sides.

    A key is missing, unexpected, there another number of times (count), or there with other values
    (changed). Row hashes are summed per bucket of the key first, in any order: one row a bucket leaves
    each task. Only rows of buckets whose sums differ are grouped by key, so equal tables cost two
    scans and no shuffle of rows. Null keys are keys; copies of a row count. Columns are matched by
    name and have to be of equal types. Different rows pass as equal with a chance of 2^-64 a key.
    """
    if {f.name: f.dataType for f in source.schema} != {f.name: f.dataType for f in target.schema}:
        raise ValueError("the two sides have different columns or types")
    rows = _signed(source, target, keys, buckets)
    # At most one row a bucket.
    open_ = rows.groupBy("__bucket").agg(_differs().alias("__open")).filter("__open").select("__bucket")
    per_key = (
        rows.join(F.broadcast(open_), "__bucket", "left_semi")
        .groupBy(*keys)
        .agg(_differs().alias("__open"), F.count_if(F.col("__side") > 0).alias("source_rows"), F.count_if(F.col("__side") < 0).alias("target_rows"))
    )
    change = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "unexpected")
        .when(F.col("source_rows") != F.col("target_rows"), "count")
        .otherwise("changed")
    )
    return per_key.filter("__open").select(*keys, change.alias("change"), "source_rows", "target_rows")


def schema_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column_name string, type string")


def schema_drift(spark: SparkSession, before: StructType, after: StructType) -> DataFrame:
    """Added, removed and retyped columns as rows."""
    old = schema_rows(spark, before).withColumnRenamed("type", "old_type")
    new = schema_rows(spark, after).withColumnRenamed("type", "new_type")
    change = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").otherwise("retyped")
    )
    joined = old.join(new, "column_name", "full").filter(~F.col("old_type").eqNullSafe(F.col("new_type")))
    return joined.select("column_name", "old_type", "new_type", change.alias("change"))
