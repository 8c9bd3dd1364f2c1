"""Clustering around centroids, each vector finding its nearest one in a vantage-point tree.

The centroids of a round make a tree: an inner node has one of them as its vantage point and
parts the others by their distance from it, a leaf holds a few. A vector visits nodes best-first,
by the least distance that the triangle inequality leaves open for them, until that passes the
best one found. The radius is inclusive, since an equally near centroid of smaller number wins.
Distances are whole numbers; roots only decide what is visited, with room for their rounding.

The tree is as large as the number of centroids allows and goes to the tasks with each round;
the vectors of a batch walk it side by side, every one by its own queue.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import written

CENTROIDS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
#: Centroids of a leaf, and vectors that walk the tree together.
LEAF, CHUNK = 2, 2048
#: Room for the rounding of roots: far above theirs, far below what a unit makes.
_ROOM = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def exact(*parts: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are, or as Python's whole numbers where squared distances may pass 64 bits."""
    top = max((abs(int(v)) for a in parts if a.size for v in (a.min(), a.max())), default=0)
    wide = parts[0].shape[1] * (2 * top) ** 2 >= _MOST
    return [a.astype(object) if wide else a for a in parts]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of every x to every y."""
    return np.stack([((x - c) ** 2).sum(1) for c in y], 1)


@dataclass(frozen=True)
class Node:
    """An inner node has one centroid and its children with the least and greatest distance to it."""

    centroids: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


def tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes, the root first."""
    nodes: list[Node] = []
    (centroids,) = exact(centroids)

    def grown(numbers: list[int]) -> int:
        at = len(nodes)
        nodes.append(Node(tuple(numbers)))
        if len(numbers) > leaf:
            # The vantage point farthest from the first one spreads the others most.
            far = squared(centroids[numbers], centroids[numbers[:1]])[:, 0]
            point = numbers[max(range(len(numbers)), key=lambda k: far[k])]
            rest = [n for n in numbers if n != point]
            away = dict(zip(rest, squared(centroids[rest], centroids[[point]])[:, 0]))
            rest.sort(key=lambda n: (away[n], n))
            children = []
            for part in (rest[: len(rest) // 2], rest[len(rest) // 2 :]):
                children.append((grown(part), float(away[part[0]]) ** 0.5, float(away[part[-1]]) ** 0.5))
            nodes[at] = Node((point,), tuple(children))
        return at

    if len(centroids):
        grown(list(range(len(centroids))))
    return nodes


def nearest(vectors: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of each vector's nearest centroid, the smaller number of
    equally near ones; and how many distances that took."""
    n = len(vectors)
    vectors, centroids = exact(vectors, centroids)
    bound = np.full((n, len(nodes)), np.inf)
    bound[:, 0] = 0
    best = np.full(n, 1 << 200, object) if vectors.dtype == object else np.full(n, _MOST)
    number, taken = np.full(n, len(centroids)), 0
    reach = np.full(n, np.inf)
    open_ = np.arange(n)
    while len(open_):
        first = bound[open_].argmin(1)
        least = bound[open_, first]
        # Inclusive: what is as near as the best one may have a smaller number.
        go = np.isfinite(least) & (least <= reach[open_])
        open_, first = open_[go], first[go]
        for at in np.unique(first).tolist():
            rows, node = open_[first == at], nodes[at]
            bound[rows, at] = np.inf
            away = squared(vectors[rows], centroids[list(node.centroids)])
            taken += away.size
            for column, c in enumerate(node.centroids):
                d, known = away[:, column], best[rows]
                better = ((d < known) | ((d == known) & (c < number[rows]))).astype(bool)
                best[rows[better]], number[rows[better]] = d[better], c
            roots = away[:, 0].astype(float) ** 0.5
            reach[rows] = best[rows].astype(float) ** 0.5 * (1 + _ROOM) + _ROOM
            for child, low, high in node.children:
                room = _ROOM * (1 + roots + high)
                bound[rows, child] = np.maximum(0, np.maximum(low - roots, roots - high) - room)
    return number, best, taken


def whole_numbers(column: pa.Array, scale: float, dimensions: int) -> np.ndarray:
    """floor(scale * x) of every component, as a cast to long it ends at its bounds."""
    flat = np.floor(scale * pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64))
    inside = np.abs(flat) < 2.0**63
    out = np.where(inside, flat, 0).astype(np.int64)
    out[~inside] = np.where(flat[~inside] > 0, _MOST, _LEAST)
    return out.reshape(-1, dimensions)


def _clipped(values) -> list[int]:
    return [min(max(int(v), _LEAST), _MOST) for v in values]


def _sums(centroids: np.ndarray, scale: float):
    """Kernel (key, vector) -> (cluster, at, total, n): a task's sums of the vectors of each centroid."""
    nodes, (k, dimensions) = tree(centroids), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, dimensions), object), np.zeros(k, np.int64)
        for _, vectors in _chunks(batches, scale, dimensions):
            number, _, _ = nearest(vectors, centroids, nodes)
            whole = vectors if np.abs(vectors.astype(float)).max() < 2.0**50 else vectors.astype(object)
            for c in np.unique(number).tolist():
                totals[c] += whole[number == c].sum(0)
                counts[c] += int((number == c).sum())
        for c in np.flatnonzero(counts).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * dimensions, pa.int32()), pa.array(range(dimensions), pa.int32()),
                 pa.array([Decimal(int(t)) for t in totals[c]], pa.decimal128(38, 0)), pa.array([int(counts[c])] * dimensions, pa.int64())],
                ["cluster", "at", "total", "n"],
            )

    return run


def _chunks(batches: Iterator[pa.RecordBatch], scale: float, dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, CHUNK):
            batch = whole.slice(at, CHUNK)
            yield batch.column(0), whole_numbers(batch.column(1), scale, dimensions)


def _placed(centroids: np.ndarray, scale: float):
    """Kernel (key, vector) -> (key, cluster, distance)."""
    nodes, dimensions = tree(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, vectors in _chunks(batches, scale, dimensions):
            number, distance, _ = nearest(vectors, centroids, nodes)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(number.astype(np.int32)), pa.array(_clipped(distance), pa.int64())], ["key", "cluster", "distance"]
            )

    return run


def usable(vector: str, dimensions: int) -> Column:
    """The vector has that many components, and all are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def clustered(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: float = SCALE, seed: str = "1:",
) -> DataFrame:
    """One row per vector: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors with exactly `dimensions` components, none null or non-finite, take part; components
    become floor(scale * x). The first centroids are the k vectors with the smallest hexadecimal
    SHA-256 of seed and key (null keys last, then by components), all if there are fewer. Each round
    assigns every vector to its nearest centroid, the smaller number of equally near ones, and
    takes floor(sum / count) of the vectors of each; a centroid without vectors stays. Repeated keys are
    vectors of their own. Components beyond 64 bits end at their bounds, and so do distances
    and inertias, after exact comparison. An empty table, or one without such vectors, gives no rows.

    A round is one scan; a task sends one sum per centroid and component, and k times `dimensions`
    numbers reach the driver.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")).filter(usable("v", dimensions))
    order = F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")).cast("binary"), 256)
    first = rows.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).select("v").toArrow()
    empty = f"key {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if first.num_rows == 0:
        return spark.createDataFrame([], empty).withColumnRenamed("key", key)
    centroids = whole_numbers(pa.concat_arrays(first.column("v").chunks), scale, dimensions)
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(centroids, scale), "cluster int, at int, total decimal(38,0), n long")
        centroids = centroids.copy()
        for r in sums.groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            centroids[r.cluster, r.at] = int(r.total) // r.n
    placed = written(rows.mapInArrow(_placed(centroids, scale), f"key {kind}, cluster int, distance long"), "clusters")
    inertia = {r.cluster: int(r.total) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = _clipped([sum(inertia.values())])[0]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(c, _clipped([t])[0], whole, digests[c]) for c, t in inertia.items()]
    # One row per centroid.
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = placed.join(F.broadcast(facts), "cluster")
    return out.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
