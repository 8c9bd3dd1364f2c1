"""Set operations, with the schema agreement checked where Spark would not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL by position; refused unless names and types line up.

    Spark checks only the types, so swapped columns of one type would be mixed up.
    """
    left = [(f.name, f.dataType) for f in a.schema]
    right = [(f.name, f.dataType) for f in b.schema]
    if left != right:
        raise ValueError(f"columns do not line up: {left} and {right}")
    return a.union(b)


def union_by_name(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b)


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row once, with the sides it occurs on: one exchange, copies combined before it."""
    both = a.withColumns({"__a": F.lit(True), "__b": F.lit(False)}).unionByName(
        b.select(*a.columns).withColumns({"__a": F.lit(False), "__b": F.lit(True)})
    )
    return both.groupBy(*a.columns).agg(F.bool_or("__a").alias("__a"), F.bool_or("__b").alias("__b"))


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """MINUS: the distinct rows of a that are not in b at all."""
    return _sides(a, b).filter("__a and not __b").drop("__a", "__b")


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return _sides(a, b).filter("__a and __b").drop("__a", "__b")
