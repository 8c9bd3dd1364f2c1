import random

import pytest
from pyspark.sql import functions as F

from lakeops.llm import topk


def brute(rows, asked, k):
    good = [(n, i, [math_floor(1024 * x) for x in v]) for n, (i, v) in enumerate(rows) if usable(i, v)]
    out = []
    for n, i, q in good:
        if asked(i):
            scores = [(-sum(a * b for a, b in zip(q, c)), j, m) for m, j, c in good if m != n]
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def math_floor(x):
    return int(x // 1)


def usable(i, v):
    return i is not None and v is not None and all(x is not None and x == x and abs(x) != float("inf") for x in v)


def found(spark, rows, k, parts=3):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).coalesce(parts)
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 5 == 0, k).collect())


@pytest.mark.parametrize("group", [4096, 4])
def test_against_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(topk, "QUERIES", group)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, rng.uniform(-1, 1)]) for _ in range(9)]) for i in range(120)]
    rows += [(i, rows[7][1]) for i in range(200, 260)]  # many equal vectors: ties
    rows += [(300, None), (305, [None] * 9), (310, [float("nan")] + [0.1] * 8), (315, [float("inf")] + [0.1] * 8), (None, [0.1] * 9), (320, []), (325, [0.5] * 4)]
    assert found(spark, rows, 10) == brute(rows, lambda i: i % 5 == 0, 10)


def test_repeated_rows_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [-1.0, 0.5])]
    assert found(spark, rows, 10, 1) == brute(rows, lambda i: i % 5 == 0, 10)
    assert found(spark, [(0, [1.0])], 10, 1) == []
    assert found(spark, [], 10, 1) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [1.0e6 + i / 1024, 3.0e5 - 7 * i, -float(i)]) for i in range(30)]
    assert found(spark, rows, 4) == brute(rows, lambda i: i % 5 == 0, 4)
