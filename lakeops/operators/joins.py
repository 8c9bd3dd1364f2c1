"""Equi-joins with an explicit strategy, star joins and collision-safe projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.skew import hot_keys
from lakeops.session import skew_session

BROADCAST_LIMIT = 64 * 1024 * 1024

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _row_bytes(schema: T.StructType) -> Column:
    """Size of one row in Spark's row format, from above: 8 bytes per field plus content."""
    total = F.lit(16 + 8 * len(schema))
    for f in schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif not isinstance(f.dataType, _FIXED_WIDTH):
            total = total + 4 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 64
    return total


#: Times the limit: estimates count columns at their widest and joins at their most.
FAR_ABOVE = 1000
#: From here on the planner knows no size.
UNKNOWN = 2**62


def measured_bytes(df: DataFrame) -> int:
    """The frame's size in memory: one aggregate, one number back to the driver."""
    size = df.agg(F.sum(_row_bytes(df.schema).cast("long")).alias("b")).first()["b"]
    return size or 0


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The frame with a broadcast hint if its measured size is within the limit.

    A larger frame comes back without a hint: Spark then shuffles both sides and adaptive
    execution splits the skewed partitions. A frame that the planner takes for far larger
    than the limit, by the sizes of its files, is not read to be measured.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if FAR_ABOVE * limit < estimate < UNKNOWN:
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def join_as(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join with strategy auto | broadcast | merge | shuffle_hash, chosen for this join only."""
    if strategy == "broadcast":
        right = broadcast_checked(right, limit)
    elif strategy in ("merge", "shuffle_hash"):
        right = right.hint(strategy)
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return left.join(right, on, how)


def exists_in(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the left whose key occurs on the right; copies of a key go before the exchange."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def not_exists_in(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the left whose key does not occur on the right, null keys among them."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def bucketed_join(
    spark: SparkSession, left: str, right: str, key: str, buckets: int, how: str = "left"
) -> DataFrame:
    """Join two catalog tables bucketed alike on `key`, without an exchange.

    A bucket is read by one task. If a key of the left table alone exceeds an average
    bucket, the join is planned without the buckets instead, in a session where adaptive
    execution splits the skewed partitions.
    """
    if hot_keys(spark.table(left), key, 1.0 / buckets).take(1):
        spark = skew_session(spark, spark__sql__sources__bucketing__enabled="false")
    return join_as(spark.table(left), spark.table(right), key, how, "merge")


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen columns (all by default), renamed with a prefix."""
    return df.select(*[F.col(c).alias(prefix + c) for c in columns or df.columns])


@dataclass(frozen=True)
class Dim:
    """A dimension: its frame, `fact_key -> dimension key`, and the attributes to bring along."""

    df: DataFrame
    fact_key: str
    key: str
    columns: Sequence[str] = field(default_factory=tuple)
    prefix: str = ""


def star_join(fact: DataFrame, dims: Sequence[Dim], strategy: str = "broadcast") -> DataFrame:
    """Fact left-joined to each dimension; only the named attributes are read and carried."""

    def attach(acc: DataFrame, dim: Dim) -> DataFrame:
        key = f"__{dim.key}"
        side = dim.df.select(
            F.col(dim.key).alias(key), *[F.col(c).alias(dim.prefix + c) for c in dim.columns]
        )
        return join_as(acc, side, F.col(dim.fact_key) == F.col(key), "left", strategy).drop(key)

    return reduce(attach, dims, fact)


def fan_out(df: DataFrame, copies: int) -> DataFrame:
    """Every row `copies` times, made in place: no join and no shuffle."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy")).drop("__copy")
