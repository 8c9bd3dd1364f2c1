"""Ranking, neighbours, running sums, latest row and top-N, with hot groups in mind.

Filters of the kind "rank <= n" stay ordinary windows: Spark cuts each group down to n
rows before the exchange. Numbering *every* row of a group cannot be cut down, and an
ordinary window would put a hot group into one task; `ordered_numbers` spreads it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.nested import stable_hash
from lakeops.session import scratch_root, shuffle_partitions

_PIECE = "__piece"


def _sorts(order: Sequence[str | Column]) -> list[Column]:
    """Sort expressions; a name with a leading "-" sorts descending, nulls last."""
    return [c if isinstance(c, Column) else F.desc_nulls_last(c[1:]) if c[0] == "-" else F.col(c) for c in order]


def _large_groups(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame | None:
    """Groups with more than an n-th of all rows, n being the number of shuffle partitions.

    There are fewer than n of them, so they come to the driver; None if there are none.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    large = counts.filter(F.col("__n") * F.lit(n) > total).drop("__n")
    rows = large.collect()
    return df.sparkSession.createDataFrame(rows, large.schema) if rows else None


def _only(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    side = F.broadcast(groups.select(*[F.col(k).alias(f"g_{k}") for k in keys]))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"g_{k}"))
    return df.join(side, match, how)


def _by_size(df: DataFrame, keys: Sequence[str], n: int, plain, spread) -> DataFrame:
    """`plain` on the ordinary groups, `spread` on the large ones, one after the other."""
    if not keys:
        return spread(df)
    large = _large_groups(df, keys, n)
    if large is None:
        return plain(df)
    return plain(_only(df, large, keys, "left_anti")).unionByName(spread(_only(df, large, keys, "left_semi")))


def ordered_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    row_number: str | None = None,
    running: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    partitions: int | None = None,
    all_large: bool = False,
) -> DataFrame:
    """Row number, running sums and lag/lead by one, over groups of any size.

    Ordinary groups take one window. The rows of a group too large for a task are
    range-partitioned by (keys, order), so that it covers many partitions; each piece is
    numbered on its own, and what precedes it comes from the pieces' summary, which has
    one row per piece.

    `all_large` says that no group is ordinary, which saves looking for the large ones.
    `order` must make rows of a group distinct. `running`, `lag`, `lead` map new column
    names to source columns; `keys` may be empty, and then the whole table is one group.
    """
    running, lag, lead = running or {}, lag or {}, lead or {}
    n = partitions or shuffle_partitions(df.sparkSession)
    out = [*df.columns, *([row_number] if row_number else []), *running, *lag, *lead]

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_sorts(order))
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        numbers = {row_number: F.row_number().over(w).cast("long")} if row_number else {}
        numbers |= {o: F.sum(src).over(upto) for o, src in running.items()}
        numbers |= {o: F.lag(src).over(w) for o, src in lag.items()}
        numbers |= {o: F.lead(src).over(w) for o, src in lead.items()}
        return rows.withColumns(numbers).select(*out)

    def spread(rows: DataFrame) -> DataFrame:
        return _spread_numbers(rows, keys, order, row_number, running, lag, lead, n)

    return spread(df) if all_large else _by_size(df, keys, n, plain, spread)


def _spread_numbers(df, keys, order, row_number, running, lag, lead, n) -> DataFrame:
    scratch_root(df.sparkSession)
    sorts = _sorts(order)
    # Range bounds are sampled, so the cut is written down before it is read twice.
    cut = (
        df.repartitionByRange(n, *[F.col(k) for k in keys], *sorts)
        .withColumn(_PIECE, F.spark_partition_id())
        .checkpoint()
    )
    w = Window.partitionBy(*keys, _PIECE).orderBy(*sorts)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = cut.withColumns(
        {
            "__rn": F.row_number().over(w).cast("long"),
            **{f"__sum_{out}": F.sum(src).over(upto) for out, src in running.items()},
            **{f"__lag_{out}": F.lag(src).over(w) for out, src in lag.items()},
            **{f"__lead_{out}": F.lead(src).over(w) for out, src in lead.items()},
            **({"__last": F.count(F.lit(1)).over(whole)} if lead else {}),
        }
    )
    offsets = _offsets(cut, keys, order, running, lag, lead)
    match = F.col(_PIECE) == F.col("o_piece")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"o_{k}"))
    # One row per piece of a large group: at most twice the number of partitions.
    joined = local.join(F.broadcast(offsets), match, "left")
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("__rn") + F.coalesce("o_rows", F.lit(0))).alias(row_number))
    for name in running:
        out.append((F.col(f"__sum_{name}") + F.coalesce(f"o_sum_{name}", F.lit(0))).alias(name))
    for name in lag:
        out.append(F.when(F.col("__rn") == 1, F.col(f"o_lag_{name}")).otherwise(F.col(f"__lag_{name}")).alias(name))
    for name in lead:
        at_end = F.col("__rn") == F.col("__last")
        out.append(F.when(at_end, F.col(f"o_lead_{name}")).otherwise(F.col(f"__lead_{name}")).alias(name))
    return joined.select(*out)


def _offsets(cut, keys, order, running, lag, lead) -> DataFrame:
    """Per piece of a group: rows and sums before it, last row before, first row after."""
    ends = {}
    if lag or lead:
        if not all(isinstance(c, str) and c[0] != "-" for c in order):
            raise ValueError("lag and lead need the order as ascending column names")
        at = F.struct(*[F.struct(F.col(c).isNotNull().alias("set"), F.col(c).alias("v")) for c in order])
        ends = {f"__tail_{o}": F.max_by(src, at) for o, src in lag.items()}
        ends |= {f"__head_{o}": F.min_by(src, at) for o, src in lead.items()}
    pieces = cut.groupBy(*keys, _PIECE).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(src).alias(f"__tot_{o}") for o, src in running.items()],
        *[c.alias(o) for o, c in ends.items()],
    )
    # At most as many rows per group as there are partitions.
    seq = Window.partitionBy(*keys).orderBy(_PIECE)
    before = seq.rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(
        *[F.col(k).alias(f"o_{k}") for k in keys],
        F.col(_PIECE).alias("o_piece"),
        F.sum("__n").over(before).alias("o_rows"),
        *[F.sum(f"__tot_{o}").over(before).alias(f"o_sum_{o}") for o in running],
        *[F.lag(f"__tail_{o}").over(seq).alias(f"o_lag_{o}") for o in lag],
        *[F.lead(f"__head_{o}").over(seq).alias(f"o_lead_{o}") for o in lead],
    )


def ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str | None = None, dense_rank: str | None = None
) -> DataFrame:
    """rank and dense_rank of every row, groups and ties of any size.

    In a large group the distinct order values are numbered instead of the rows, for
    peers share both numbers: the dense rank is the value's row number, the rank follows
    from the running count of rows.
    """
    marks = [c.lstrip("-") for c in order]
    out = [*df.columns, *([rank] if rank else []), *([dense_rank] if dense_rank else [])]

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_sorts(order))
        numbers = {rank: F.rank().over(w).cast("long")} if rank else {}
        numbers |= {dense_rank: F.dense_rank().over(w).cast("long")} if dense_rank else {}
        return rows.withColumns(numbers).select(*out)

    def spread(rows: DataFrame) -> DataFrame:
        peers = rows.groupBy(*keys, *marks).agg(F.count(F.lit(1)).alias("__peers"))
        n = shuffle_partitions(df.sparkSession)
        numbered = _spread_numbers(peers, keys, order, "__dense", {"__upto": "__peers"}, {}, {}, n)
        side = numbered.select(
            *[F.col(c).alias(f"p_{c}") for c in (*keys, *marks)],
            (F.col("__upto") - F.col("__peers") + 1).alias("__rank"),
            "__dense",
        )
        match = F.lit(True)
        for c in (*keys, *marks):
            match = match & F.col(c).eqNullSafe(F.col(f"p_{c}"))
        named = {rank: F.col("__rank")} if rank else {}
        named |= {dense_rank: F.col("__dense")} if dense_rank else {}
        return rows.join(side, match).withColumns(named).select(*out)

    return _by_size(df, keys, shuffle_partitions(df.sparkSession), plain, spread)


def latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], extra: Sequence[Column] = ()
) -> DataFrame:
    """The newest row per key, nulls oldest.

    Ties are broken by `extra` and then by a hash of the row, so that a rerun picks the
    same row. Spark keeps one row per key and task before the exchange.
    """
    by = [F.col(c).desc_nulls_last() for c in order]
    w = Window.partitionBy(*keys).orderBy(*by, *extra, stable_hash(df).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, how: str = "row_number", name: str = "rn"
) -> DataFrame:
    """Rows whose row_number, rank or dense_rank within the group is at most n."""
    number = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[how]
    w = Window.partitionBy(*keys).orderBy(*_sorts(order))
    return df.withColumn(name, number().over(w)).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("long"))


def qualify(df: DataFrame, expression: Column, predicate: Column | None = None, name: str = "q") -> DataFrame:
    """Filter on a window expression without keeping it: `predicate` speaks of `name`."""
    kept = df.withColumn(name, expression).filter(predicate if predicate is not None else F.col(name) == 1)
    return kept.drop(name)


def keep_last_max(order: str, value: str) -> Column:
    """MAX(value) KEEP (DENSE_RANK LAST ORDER BY order), all ties considered."""
    return F.max(F.when(F.col(order).isNotNull(), F.struct(order, value)))[value]


def keep_first_min(order: str, value: str) -> Column:
    """MIN(value) KEEP (DENSE_RANK FIRST ORDER BY order), all ties considered."""
    known = F.struct(F.col(order).alias("o"), F.col(value).isNull().alias("n"), F.col(value).alias("v"))
    return F.min(F.when(F.col(order).isNotNull(), known))["v"]
