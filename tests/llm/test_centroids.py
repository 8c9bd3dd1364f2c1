"""Clusters against plain k-means in whole numbers; the tree against all distances."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from lakeops.llm.centroids import clustered, nearest, squared, tree
from lakeops.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>"


def plain(rows, k=16, rounds=3, dimensions=64):
    import math

    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        parts = {}
        for _, v in kept:
            parts.setdefault(near(v), []).append(v)
        for c, vs in parts.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, c := near(v), far(v, centroids[c])) for i, v in kept]
    total = {c: sum(d for _, x, d in out if x == c) for _, c, _ in out}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, total[c], sum(total.values()), digest[c]) for i, c, d in out), key=repr)


def test_tree_finds_what_all_distances_find():
    rng = np.random.default_rng(1)
    for n, dimensions, spread in ((1, 4, 3), (2, 4, 3), (16, 2, 3), (40, 3, 50), (64, 64, 9)):
        centroids, vectors = rng.integers(-spread, spread, (n, dimensions)), rng.integers(-spread, spread, (500, dimensions))
        number, distance, taken = nearest(vectors, centroids, tree(centroids))
        away = squared(vectors, centroids)
        assert (number == away.argmin(1)).all() and (distance == away.min(1)).all()
        assert taken <= away.size
    # Ties: equal centroids, and vectors half way between two.
    same = np.array([[2, 0], [0, 0], [2, 0], [0, 0], [4, 0], [4, 0]])
    number, distance, _ = nearest(np.array([[1, 0], [3, 0], [0, 0]]), same, tree(same))
    assert number.tolist() == [0, 0, 1] and distance.tolist() == [1, 1, 0]


def test_tree_saves_distances_where_vectors_are_apart():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-1000, 1000, (256, 2))
    _, _, taken = nearest(rng.integers(-1000, 1000, (1000, 2)), centroids, tree(centroids))
    assert taken < 0.4 * 1000 * 256


def test_numbers_beyond_64_bits_are_compared_exactly():
    big = 1 << 61
    centroids = np.array([[big, 0], [big - 1, 0], [-big, 0]])
    number, distance, _ = nearest(np.array([[-big, 1], [big, 0]]), centroids, tree(centroids))
    assert number.tolist() == [2, 0] and list(distance) == [1, 0]


def test_whole_table(spark):
    out = QUERIES["op12_vantage_tree_clusters"](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, out.collect()), key=repr) == plain(rows)
    assert [d for _, d in out.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_nulls_ties_repeated_rows_and_clashing_names(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(60)]
    rows += [rows[0]] * 20 + [(None, [0.0, 0.0, 0.0]), (None, [1.0, 0.0, -1.0]), (61, None), (62, [1.0]), (63, [1.0, None, 2.0]), (64, [float("nan"), 1.0, 1.0]), (65, [float("inf"), 1.0, 1.0])]
    frame = spark.createDataFrame(rows, KIND).select("*", *[F.lit("x").alias(c) for c in ("key", "v", "h", "cluster", "distance")])
    assert sorted(map(tuple, clustered(frame, dimensions=3).collect()), key=repr) == plain(rows, dimensions=3)
    few = rows[:5]
    assert sorted(map(tuple, clustered(spark.createDataFrame(few, KIND), dimensions=3).collect()), key=repr) == plain(few, dimensions=3)


def test_very_large_components(spark):
    rows = [(1, [3e38, -3e38]), (2, [1.0, 2.0]), (3, [3e38, 3e38])]
    out = {r.vec_id: r for r in clustered(spark.createDataFrame(rows, KIND), k=2, dimensions=2).collect()}
    assert len(out) == 3 and all(0 <= r.distance <= (1 << 63) - 1 for r in out.values())


def test_empty_table(spark):
    assert clustered(spark.createDataFrame([], KIND)).collect() == []
    assert clustered(spark.createDataFrame([(1, [1.0]), (2, None)], KIND)).collect() == []
