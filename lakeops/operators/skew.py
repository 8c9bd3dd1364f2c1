"""Skew: profile, hot keys, salted joins and salted aggregation.

Salts are hashes of the row's own key, never random numbers: a task that is run again
after a lost executor must send each row to the same place.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from lakeops.functions.combine import partials, wholes
from lakeops.functions.money import minor_units
from lakeops.session import shuffle_partitions

SALT, HOT = "__salt", "__is_hot"
#: So many hot keys are broadcast; more are joined by a shuffle.
HOT_KEYS = 100_000


def skew_profile(df: DataFrame, key: str, k: int = 20, hot_share: float = 0.05) -> DataFrame:
    """The k most frequent keys with row count, share of all rows and a hot flag."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    shares = counts.select(
        key, "n_rows", (F.col("n_rows") / total).alias("share"), (F.col("n_rows") > F.lit(hot_share) * total).alias("is_hot")
    )
    return shares.orderBy(F.desc("n_rows"), F.asc_nulls_first(key)).limit(k)


def hot_keys(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """Keys holding more than `share` of the rows: at most 1/share of them.

    The first pass keeps a fixed-size candidate list per task (a key above the share
    cannot drop out of it), so no shuffle by key; the second pass counts the candidates.
    Shares too small for such a list are found by counting every key.
    """
    slim = df.select(key)
    total = slim.agg(F.count(F.lit(1)).alias("n")).scalar()
    if share < 0.001:
        counts = slim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        return counts.filter(F.col("n_rows") > total * F.lit(share))
    found = slim.stat.freqItems([key], min(share, 0.25)).first()[0]
    # Null never equals a join key, so it is not a hot join key.
    candidates = [v for v in found if v is not None]
    counted = slim.filter(F.col(key).isin(candidates)).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > total * F.lit(share))


def salt_of(row_key: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*row_key), F.lit(n)).cast("int")


def salts_for(df: DataFrame, key: str) -> int:
    """Salts after which no key has more than an average task's rows: the hottest key's share of them."""
    tasks = shuffle_partitions(df.sparkSession)
    total = df.count()
    most = hot_keys(df, key, 1.0 / tasks).agg(F.max("n_rows").alias("n")).first()["n"] or 0
    return max(1, math.ceil(most * tasks / max(1, total)))


@dataclass(frozen=True)
class SaltPlan:
    """How many salts each hot key of a fact gets; every other key has one.

    `counts` are a hot key's rows, from a sketch: at most a little more than there are.
    """

    key: str
    kind: DataType
    total: int
    tasks: int
    counts: tuple[tuple[object, int], ...]

    @property
    def salts(self) -> dict:
        """As many as it takes for a salt's rows to be those of an average task."""
        return {k: math.ceil(n * self.tasks / self.total) for k, n in self.counts}

    def frame(self, spark: SparkSession) -> DataFrame:
        """(__hot_key, __salts), fewer rows than `tasks`."""
        kind = StructType().add("__hot_key", self.kind).add("__salts", "integer")
        return spark.createDataFrame(list(self.salts.items()), kind)

    def spread(self, fact: DataFrame, row_key: Sequence[str]) -> DataFrame:
        """The fact with a salt; rows without a key meet nothing, and are spread over all tasks."""
        if not self.counts:
            return fact.withColumn(SALT, F.when(F.col(self.key).isNull(), salt_of(row_key, self.tasks)).otherwise(F.lit(0)))
        joined = fact.join(F.broadcast(self.frame(fact.sparkSession)), F.col(self.key) == F.col("__hot_key"), "left")
        n = F.coalesce("__salts", F.when(F.col(self.key).isNull(), F.lit(self.tasks)).otherwise(F.lit(1)))
        return joined.withColumn(SALT, F.pmod(F.xxhash64(*row_key), n).cast("int")).drop("__hot_key", "__salts")

    def copied(self, dim: DataFrame) -> DataFrame:
        """The dimension with a copy of each hot key's rows for each of its salts; no other row is copied."""
        if not self.counts:
            return dim.withColumn(SALT, F.lit(0))
        joined = dim.join(F.broadcast(self.frame(dim.sparkSession)), F.col(self.key) == F.col("__hot_key"), "left")
        return joined.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hot_key", "__salts")


def salt_plan(fact: DataFrame, key: str, share: float | None = None) -> SaltPlan:
    """Keys with more than `share` of the rows (by default an average task's), in one pass.

    Every task keeps a sketch of a fixed size and nothing is shuffled by key. Such a sketch
    of frequent items loses no key whose share is above its resolution, which is an eighth of `share`.
    """
    tasks = shuffle_partitions(fact.sparkSession)
    share = share or 1.0 / tasks
    tracked = min(1_000_000, max(64, 2 ** math.ceil(math.log2(12 / share))))
    most = min(tracked, math.ceil(1 / share) + 1)
    row = fact.agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    counts = tuple((r["item"], r["count"]) for r in row["top"] or [] if r["item"] is not None and r["count"] > share * row["total"])
    return SaltPlan(key, fact.schema[key].dataType, max(1, row["total"]), tasks, counts)


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, row_key: Sequence[str], n: int | None = None, how: str = "left"
) -> DataFrame:
    """Join on (key, salt): each hot key of the fact is spread over tasks, its dimension rows are copied.

    A plan measured in one pass gives every hot key its own number of salts. With `n` all keys are
    spread over n tasks instead, and the whole dimension is copied n times. `how` is "inner" or
    "left"; with other types a copied row could come out several times.
    """
    _check(how)
    if n is None:
        plan = salt_plan(fact, key)
        return plan.spread(fact, row_key).join(plan.copied(dim), [key, SALT], how).drop(SALT)
    left = fact.withColumn(SALT, salt_of(row_key, n))
    right = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return left.join(right, [key, SALT], how).drop(SALT)


def concat_salted_join(
    fact: DataFrame, dim: DataFrame, key: str, row_key: Sequence[str], n: int | None = None, how: str = "left"
) -> DataFrame:
    """The same with one text key "<key>_<salt>", for callers that need a single join column."""
    _check(how)
    salted = "__salted_key"
    text = F.concat(F.col(key).cast("string"), F.lit("_"), F.col(SALT).cast("string"))
    if n is None:
        plan = salt_plan(fact, key)
        left, copies = plan.spread(fact, row_key), plan.copied(dim)
    else:
        left = fact.withColumn(SALT, salt_of(row_key, n))
        copies = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    left = left.withColumn(salted, text).drop(SALT)
    return left.join(copies.withColumn(salted, text).drop(key, SALT), salted, how).drop(salted)


def _marked(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The frame with a column that is true for the hot keys; broadcast if there are few of them."""
    flags = hot.select(F.col(key).alias("__hot_key")).filter(F.col("__hot_key").isNotNull()).distinct()
    few = flags.limit(HOT_KEYS + 1).count() <= HOT_KEYS
    side = F.broadcast(flags) if few else flags
    joined = df.join(side, F.col(key) == F.col("__hot_key"), "left")
    return joined.withColumn(HOT, F.col("__hot_key").isNotNull()).drop("__hot_key")


def partial_salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    row_key: Sequence[str],
    hot: DataFrame | None = None,
    n: int | None = None,
    share: float | None = None,
    how: str = "left",
) -> DataFrame:
    """Salt only the hot keys; the others keep salt 0 and one dimension row.

    Without `hot` the keys above `share` are found first, by default those with more rows
    than an average task, each with the number of salts that its share asks for. With `hot` or `n`
    every hot key has n of them, by default as many as there are shuffle partitions.
    """
    _check(how)
    if hot is None and n is None:
        plan = salt_plan(fact, key, share)
        return plan.spread(fact, row_key).join(plan.copied(dim), [key, SALT], how).drop(SALT)
    tasks = shuffle_partitions(fact.sparkSession)
    n = n or tasks
    if hot is None:
        hot = hot_keys(fact, key, share or 1.0 / tasks)
    # A null key meets no dimension row; spread such rows as well.
    spread = F.col(HOT) | F.col(key).isNull()
    left = _marked(fact, key, hot).withColumn(SALT, F.when(spread, salt_of(row_key, n)).otherwise(F.lit(0))).drop(HOT)
    salts = F.when(F.col(HOT), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    right = _marked(dim, key, hot).withColumn(SALT, F.explode(salts)).drop(HOT)
    return left.join(right, [key, SALT], how).drop(SALT)


def _check(how: str) -> None:
    if how not in ("inner", "left"):
        raise ValueError("salted joins keep their meaning for inner and left joins only")


def salted_totals(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    row_key: Sequence[str],
    n: int | None = None,
    hot: DataFrame | None = None,
    scale: int = 2,
) -> DataFrame:
    """n_rows, total and average per key in two stages: by (key, salt), then by key.

    The average is put together from sum and count. Without `n` and `hot` there is one salt: each
    task's partial aggregation already leaves one row of a hot key. With `hot` (rows of the
    first key column) only those keys are salted, n times or as often as there are tasks.
    """
    if hot is not None and n is None:
        n = shuffle_partitions(df.sparkSession)
    salt = salt_of(row_key, n or 1)
    if hot is not None:
        df = _marked(df, keys[0], hot)
        salt = F.when(F.col(HOT), salt).otherwise(F.lit(0))
    parts = (
        (df.withColumn(SALT, salt).groupBy(*keys, SALT) if n else df.groupBy(*keys))
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.count(amount).alias("__n"),
            F.sum(minor_units(amount, scale)).alias("__units"),
        )
    )
    whole = parts.groupBy(*keys).agg(
        F.sum("__rows").alias("n_rows"), F.sum("__n").alias("__n"), F.sum("__units").alias("__units")
    )
    one = F.lit(float(10**scale))
    units = F.col("__units").cast("double")
    return whole.select(
        *keys, "n_rows", (units / one).alias("total"), F.try_divide(units, F.col("__n") * one).alias("average")
    )


def salted_agg(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, str]], row_key: Sequence[str], n: int | None = None
) -> DataFrame:
    """Any of count, sum, min, max and avg per key in two stages, the first by (key, salt).

    `aggs` maps result names to (function, column), the column of a count being "*" for
    all rows. Without n there is one salt, as each task sends one row of a key anyway.
    """
    if n is None:
        return df.groupBy(*keys).agg(*partials(aggs)).groupBy(*keys).agg(*wholes(aggs))
    parts = df.withColumn(SALT, salt_of(row_key, n)).groupBy(*keys, SALT).agg(*partials(aggs))
    return parts.groupBy(*keys).agg(*wholes(aggs))
