"""Group aggregates. All of them combine on the map side before the exchange."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.combine import partials, wholes
from lakeops.functions.money import exact_avg, exact_sum, from_minor, minor_units
from lakeops.operators.layout import reused
from lakeops.operators.skew import hot_keys
from lakeops.operators.windows import ordered_numbers
from lakeops.session import shuffle_partitions


def kpi(df: DataFrame, keys: Sequence[str], amount: str, scale: int | None = 2) -> DataFrame:
    """txns, total_amount and avg_amount per group; a scale of None sums doubles of any kind exactly."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("txns"),
        exact_sum(amount, scale).alias("total_amount"),
        exact_avg(amount, scale).alias("avg_amount"),
    )


def daily_kpi(df: DataFrame, ts: str, keys: Sequence[str], amount: str, scale: int | None = 2) -> DataFrame:
    return kpi(df.withColumn("dt", F.to_date(ts)), ["dt", *keys], amount, scale)


def count_where(condition: Column) -> Column:
    """Rows of the group for which the condition holds; null does not count."""
    return F.count_if(condition)


def sum_where(condition: Column, amount: str, scale: int | None = 2) -> Column:
    if scale is None:
        return exact_sum(F.when(condition, F.col(amount)).otherwise(F.lit(0.0)), None)
    return from_minor(F.sum(F.when(condition, minor_units(amount, scale)).otherwise(F.lit(0))), scale)


def _levels(grouped, scale: int) -> DataFrame:
    return grouped.agg(
        F.grouping_id().alias("level"),
        F.sum("txns").alias("txns"),
        from_minor(F.sum("units"), scale).alias("total_amount"),
    )


def _parts(df: DataFrame, keys: Sequence[str], amount: str, scale: int) -> DataFrame:
    """One row per finest group. Rollup and cube copy their input once per level, so they get this instead of raw rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("txns"), F.sum(minor_units(amount, scale)).alias("units"))


def rollup_kpi(df: DataFrame, keys: Sequence[str], amount: str, scale: int = 2) -> DataFrame:
    """txns and total per rollup level; `level` is the grouping id, which tells a total from a null key."""
    return _levels(_parts(df, keys, amount, scale).rollup(*keys), scale)


def cube_kpi(df: DataFrame, keys: Sequence[str], amount: str, scale: int = 2) -> DataFrame:
    return _levels(_parts(df, keys, amount, scale).cube(*keys), scale)


def grouping_sets_kpi(
    df: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str], amount: str, scale: int = 2
) -> DataFrame:
    return _levels(_parts(df, keys, amount, scale).groupingSets([list(s) for s in sets], *keys), scale)


def levels_agg(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    sets: Sequence[Sequence[str]] | str = "rollup",
) -> DataFrame:
    """Any of count, sum, min, max and avg over a "rollup", a "cube" or the given grouping sets.

    `aggs` maps result names to (function, column). The finest groups are aggregated first,
    and the levels put their partial results together; `level` is the grouping id.
    """
    finest = df.groupBy(*keys).agg(*partials(aggs))
    if isinstance(sets, str):
        grouped = {"rollup": finest.rollup, "cube": finest.cube}[sets](*keys)
    else:
        grouped = finest.groupingSets([list(s) for s in sets], *keys)
    return grouped.agg(F.grouping_id().alias("level"), *wholes(aggs))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, amount: str, scale: int | None = 2
) -> DataFrame:
    """PIVOT: the sum per listed value as a column, null where a group has no such row.

    The list is given, so nothing has to be discovered first; conditional sums need one
    exchange where `pivot` needs two.
    """
    sums = [exact_sum(F.when(F.col(column) == F.lit(v), F.col(amount)), scale).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*sums)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([F.col(k) for k in keys], [F.col(c) for c in columns], name, value)


def list_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    part_size: int = 10_000,
    distinct: bool = False,
) -> DataFrame:
    """Ordered lists per group as numbered parts (keys, part, n_items, items).

    One cell cannot hold a group of any size, so a group is cut every `part_size` items;
    a group no larger than that is one row with part 0. Positions are found with the
    distributed numbering, so no task holds a whole hot group.
    """
    extra = [c.lstrip("-") for c in order]
    slim = df.select(*keys, F.col(value).alias("__v"), *[c for c in extra if c not in (*keys, value)])
    slim = slim.filter(F.col("__v").isNotNull())
    if distinct:
        slim = slim.select(*keys, "__v").distinct()
        order = ["__v"]
    order = [c.replace(value, "__v") if c.lstrip("-") == value else c for c in order]
    numbered = ordered_numbers(slim, keys, order, row_number="__rn")
    parts = numbered.withColumn("part", F.expr(f"(__rn - 1) div {int(part_size)}"))
    return (
        parts.groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(F.struct("__rn", "__v"))).alias("__items"))
        .select(*keys, "part", F.size("__items").cast("long").alias("n_items"), F.col("__items.__v").alias("items"))
    )


def list_text(df: DataFrame, keys: Sequence[str], value: str, order: Sequence, sep: str = ",", **kw) -> DataFrame:
    """Ordered list aggregation to text, in the parts of `list_parts`."""
    return list_parts(df, keys, value, order, **kw).withColumn("items", F.array_join("items", sep))


def from_daily(daily: DataFrame, keys: Sequence[str], scale: int = 2) -> DataFrame:
    """Re-aggregate a daily table (txns, units, lo, hi) to coarser keys; the average comes from its parts."""
    units = F.sum("units").cast("double")
    return daily.groupBy(*keys).agg(
        F.sum("txns").alias("txns"),
        from_minor(F.sum("units"), scale).alias("total_amount"),
        F.min("lo").alias("min_amount"),
        F.max("hi").alias("max_amount"),
        F.try_divide(units, F.sum("txns") * F.lit(float(10**scale))).alias("avg_amount"),
    )


def daily_parts(df: DataFrame, ts: str, keys: Sequence[str], amount: str, scale: int = 2) -> DataFrame:
    """The daily table that `from_daily` re-aggregates, in units of the same scale."""
    return (
        df.withColumn("dt", F.to_date(ts))
        .groupBy(*keys, "dt")
        .agg(
            F.count(amount).alias("txns"),
            F.sum(minor_units(amount, scale)).alias("units"),
            F.min(amount).alias("lo"),
            F.max(amount).alias("hi"),
        )
    )


def one_exchange(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """Rows laid out by key so that several aggregates on (key, ...) need no further exchange.

    Laying out raw rows puts a hot key into one task. If a key holds more than `share` of the
    rows, by default as many as an average task, the frame comes back as it is, and
    each aggregate does its own map-side combine and small exchange.
    """
    share = share or 1.0 / shuffle_partitions(df.sparkSession)
    return df if hot_keys(df, key, share).take(1) else df.repartition(key)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), F.asc_nulls_first(column))


# Relative rank error of the quantile sketch is 1 / SKETCH.
SKETCH = 2_000


def numeric_profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: count, nulls, mean, stddev, min, max and exact quantiles.

    Quantiles interpolate between neighbours. A sketch, taken along with the other
    numbers, brackets each one; only the values inside a bracket are then put in order,
    spread over tasks. A bracket that turns out not to hold its quantile is widened to
    the whole column, so the result is exact in any case.
    """
    names = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    margin = 2.0 / SKETCH
    ends = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    one_pass = [
        expr.alias(f"{name}_{i}")
        for i, c in enumerate(names)
        for name, expr in {
            "n": F.count(c),
            "n_null": F.count_if(F.col(c).isNull()),
            "mean": F.avg(c),
            "stddev": F.round(F.stddev(c), 4),
            "min": F.min(c),
            "max": F.max(c),
            "ends": F.percentile_approx(c, ends, SKETCH),
        }.items()
    ]
    row = values.agg(*one_pass).first()
    known = df.sparkSession.createDataFrame(
        [(c, *[row[f"{f}_{i}"] for f in ("n", "n_null", "mean", "stddev", "min", "max")]) for i, c in enumerate(names)],
        "column_name string, n long, n_null long, mean double, stddev double, min double, max double",
    )
    wanted = [
        (c, j, p * (row[f"n_{i}"] - 1), row[f"ends_{i}"][2 * j], row[f"ends_{i}"][2 * j + 1])
        for i, c in enumerate(names)
        if row[f"n_{i}"]
        for j, p in enumerate(probs)
    ]
    if not wanted:
        return known.withColumns({_quantile(p): F.lit(None).cast("double") for p in probs})
    below, inside = _bracket_counts(values, wanted)
    brackets = [
        (c, i, pos, lo, hi, float(b)) if b <= int(pos) and b + n > -(-pos // 1) else (c, i, pos, None, None, 0.0)
        for (c, i, pos, lo, hi), b, n in zip(wanted, below, inside)
    ]
    # The brackets are few and known: each value is tested against its column's, and only what is inside becomes a row.
    def inside_bracket(c: str, i: int, pos: float, lo, hi, before: float) -> Column:
        keep = F.col(c).isNotNull() if lo is None else F.col(c).between(F.lit(lo), F.lit(hi))
        fields = [F.lit(c).alias("column_name"), F.lit(i).alias("i"), F.lit(float(pos)).alias("pos"), F.lit(before).alias("below")]
        return F.when(keep, F.struct(*fields, F.col(c).alias("v")))

    rows = F.array(*[inside_bracket(*bracket) for bracket in brackets])
    held = values.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = held.groupBy("column_name", "i", "pos", "below", "v").agg(F.count(F.lit(1)).alias("__c"))
    with reused(counts) as kept:
        running = ordered_numbers(kept, ["column_name", "i"], ["v"], running={"__upto": "__c"}, all_large=True)
    upto = F.col("below") + F.col("__upto")
    before = upto - F.col("__c")

    def at(position: Column) -> Column:
        return F.max(F.when((position >= before) & (position < upto), F.col("v")))

    neighbours = running.groupBy("column_name", "i", "pos").agg(at(F.floor("pos")).alias("a"), at(F.ceil("pos")).alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))
    quantiles = neighbours.groupBy("column_name").agg(
        *[F.max(F.when(F.col("i") == i, value)).alias(_quantile(p)) for i, p in enumerate(probs)]
    )
    return known.join(quantiles, "column_name", "left")


def _quantile(p: float) -> str:
    return f"p{round(p * 100)}"


def _bracket_counts(values: DataFrame, wanted: Sequence[tuple]) -> tuple[list[int], list[int]]:
    """Rows below and inside each (column, i, pos, lo, hi), in one pass."""
    exprs = []
    for n, (c, _, _, lo, hi) in enumerate(wanted):
        exprs.append(F.count_if(F.col(c) < F.lit(lo)).alias(f"b{n}"))
        exprs.append(F.count_if(F.col(c).between(F.lit(lo), F.lit(hi))).alias(f"i{n}"))
    row = values.agg(*exprs).first()
    return [row[f"b{n}"] for n in range(len(wanted))], [row[f"i{n}"] for n in range(len(wanted))]
