"""Exact top-k inner products in three phases with a uniform threshold.

The components are cut into blocks, and the lists of the search are a query's partial scores
in each block. First every task sends, for each query, the best totals among the heads of
its lists: the k-th of all is a safe cutoff, as no answer is below it. An answer then has a
partial score of cutoff / blocks in some block at least. So with the cutoff sent back, each
task collects the entries that reach this, drops those whose other blocks at the threshold
could not make up for it, and resolves the rest exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import written

#: Queries taken at a time (so many vectors are broadcast), and candidates in a matrix.
QUERIES, CANDIDATES = 4096, 1024
BLOCKS = 4
#: Whole numbers up to here are exact in a double.
EXACT = 2.0**53


def usable(vector: str) -> Column:
    """The vector is there, and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of each vector, shorter ones filled up with zeros; as a cast to long, it ends at its bounds."""
    counts = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = np.floor(scale * pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(counts.max(initial=0))
    if (counts == width).all():
        return flat.reshape(len(counts), width)
    out = np.zeros((len(counts), width))
    out[np.arange(width) < counts[:, None]] = flat
    return out


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _scores(queries: np.ndarray, some: np.ndarray, blocks: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Partial scores of each block, and totals; no partial scores where doubles are not exact."""
    width = max(queries.shape[1], some.shape[1])
    q, c = _widened(queries, width), _widened(some, width)
    if width * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * blocks < EXACT:
        cuts = [width * b // blocks for b in range(blocks + 1)]
        parts = [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:])]
        return parts, sum(parts[1:], parts[0].copy())
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    longs = [np.where(x >= 2.0**63, high, np.where(x <= -(2.0**63), low, np.clip(x, -(2.0**62) * 1.99, 2.0**62 * 1.99).astype(np.int64))) for x in (q, c)]
    with np.errstate(over="ignore"):
        return [], longs[0] @ longs[1].T


def _heads(queries: np.ndarray, own: np.ndarray, scale: float, k: int, blocks: int):
    """Kernel (row, id, vector) -> (query, score): a task's best totals among the heads of its lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[np.ndarray]] = []
        for rows, _, some in _chunks(batches, scale):
            parts, total = _scores(queries, some, blocks)
            mine = rows[None, :] == own[:, None]
            head = min(k + 1, len(rows))
            tops = [np.argpartition(-p, head - 1, axis=1)[:, :head] for p in (parts or [total])]
            at = np.sort(np.concatenate(tops, axis=1), axis=1)
            fresh = np.ones(at.shape, bool)
            fresh[:, 1:] = at[:, 1:] != at[:, :-1]
            fresh &= ~np.take_along_axis(mine, at, 1)
            q, j = np.nonzero(fresh)
            best = _kept([*best, [q, np.take_along_axis(total, at, 1)[q, j].astype(np.int64)]], k)
        for q, score in best:
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(score)], ["query", "score"])

    return run


def _kept(parts: list[list[np.ndarray]], k: int) -> list[list[np.ndarray]]:
    """The k greatest scores of each query (then the smaller of the columns behind), as one part."""
    columns = [np.concatenate(x) for x in zip(*parts)]
    order = np.lexsort([*columns[:1:-1], ~columns[1], columns[0]])
    columns = [x[order] for x in columns]
    q = columns[0]
    first = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - first < k
    return [[x[keep] for x in columns]]


def _resolved(queries: np.ndarray, own: np.ndarray, cutoff: np.ndarray, known: np.ndarray, scale: float, k: int, blocks: int):
    """Kernel (row, id, vector) -> (query, score, id, row): a task's best entries that reach the cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[np.ndarray]] = []
        for rows, ids, some in _chunks(batches, scale):
            parts, total = _scores(queries, some, blocks)
            limit = cutoff[:, None]
            if parts:
                bound, seen = np.zeros(total.shape), np.zeros(total.shape, bool)
                for p in parts:
                    p = p * blocks
                    bound += np.maximum(p, limit)
                    seen |= p >= limit
                possible = seen & (bound >= limit * blocks)
                possible |= ~known[:, None]
            else:
                possible = np.ones(total.shape, bool)
            q, j = np.nonzero(possible)
            score = total[q, j].astype(np.int64)
            reach = ((score >= cutoff[q]) | ~known[q]) & (rows[j] != own[q])
            q, j, score = q[reach], j[reach], score[reach]
            best = _kept([*best, [q, score, ids[j], rows[j]]], k)
        for q, score, i, row in best:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q.astype(np.int32), score, i, row)], ["query", "score", "id", "row"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, CANDIDATES):
            batch = whole.slice(at, CANDIDATES)
            yield batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), scale)


def top_k(
    vectors: DataFrame, asked: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: float = 1024, blocks: int = BLOCKS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each row for which
    `asked` holds with all rows but itself, on components floor(scale * x).

    Equal scores go by the smaller key, then by the first row. Rows without a key, and vectors
    that are null or hold null or non-finite components, take no part; shorter vectors
    count as filled up with zeros. Scores beyond 64 bits wrap. Repeated rows are rows of
    their own. Queries go in groups of about QUERIES, each by two scans of the candidates,
    so what is broadcast does not grow. `vectors` must be a scan or another frame whose
    partitions are the same when computed again.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), asked.alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & usable("v"))
    wanted = written(rows.filter("asked").select("row", "id", "v"), "queries")
    candidates = rows.select("row", "id", "v")
    count = wanted.count()
    groups = max(1, -(-count // QUERIES))
    parts = []
    for g in range(groups):
        own = wanted.filter(F.pmod(F.xxhash64("row"), F.lit(groups)) == g).sort("row").toArrow().combine_chunks()
        if own.num_rows == 0:
            continue
        number, ids = own.column("row").to_numpy(), own.column("id").to_numpy()
        matrix = _matrix(own.column("v").combine_chunks() if own.column("v").num_chunks != 1 else own.column("v").chunk(0), scale)
        heads = candidates.mapInArrow(_heads(matrix, number, scale, k, blocks), "query int, score long")
        best = Window.partitionBy("query").orderBy(F.desc("score"))
        safe = heads.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k)
        cutoff, known = np.zeros(own.num_rows), np.zeros(own.num_rows, bool)
        for r in safe.groupBy("query").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).collect():
            cutoff[r.query], known[r.query] = r.score, True
        found = candidates.mapInArrow(_resolved(matrix, number, cutoff, known, scale, k, blocks), "query int, score long, id long, row long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"query": pa.array(np.arange(len(ids), dtype=np.int32)), "query_id": pa.array(ids)}))
        top = top.join(F.broadcast(names), "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
        parts.append(written(top, "top-k"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
