"""Near-duplicate components against all pairs of whole sets."""

import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
from tests.llm.cases import CLASHING, edge, empty, words
from pyspark.sql import functions as F

from lakeops.llm.bayes_pairs import HASHES, STEP, _join, least_matches, near_components, signatures
from lakeops.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def everything(rows):
    """(doc_id, n, component, kept) of unique ids by all pairs that share a gram."""
    sets = {i: grams(t) for i, t in rows}
    having, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_set = defaultdict(list)
    for i, s in sorted(sets.items()):
        if s:
            by_set[s].append(i)
    common = defaultdict(int)
    for s, ids in by_set.items():
        for i in ids[1:]:
            parent[find(i)] = find(ids[0])
        for g in s:
            for other in having[g]:
                common[other, ids[0]] += 1
            having[g].append(ids[0])
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for i in sorted(sets):
        least.setdefault(find(i), i)
    return sorted((i, len(s), least[find(i)], least[find(i)] == i) for i, s in sets.items())


def test_whole_table_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op13_bayes_near_dedup"](spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = everything(rows)
    assert sorted(map(tuple, out.collect())) == want
    assert sum(not w[3] for w in want) > 20


def test_dense_group_whose_links_lead_over_others(spark):
    rng = random.Random(5)
    first = words(rng, 150)
    rows = [(0, " ".join(first))]
    for i in range(1, 1500):
        # Copies of the first text and of one another, with one to seven words changed.
        own = (first if rng.random() < 0.6 else rows[rng.randrange(i)][1].split())[:]
        for _ in range(rng.randrange(1, 8)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    out = near_components(spark.createDataFrame(rows, "doc_id long, text string"))
    want = everything(rows)
    assert len({w[2] for w in want}) > 3
    assert sorted(map(tuple, out.collect())) == want


def test_threshold_itself_is_a_link(spark):
    # 17 of 20 distinct grams in common: exactly 0.85.
    a = [f"w{i}" for i in range(21)]
    b = a + ["y1", "y2", "y3"]
    c = a + ["y1", "y2", "y3", "y4"]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (5, " ".join(a[:2])), (6, " ".join(a[:2]).upper()), (7, "É a"), (8, "é a")]
    assert sorted(map(tuple, near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == everything(rows)
    rows = [(1, " ".join(a)), (2, " ".join(c))]
    assert [r.kept for r in near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [True, True]


def test_nulls_repeated_keys_long_texts_and_clashing_names(spark):
    docs = edge(spark)
    more = docs.select("*", *[F.lit("x").alias(c) for c in ("signature", "part", "unit") if c not in CLASHING])
    out = sorted(map(tuple, near_components(more).collect()), key=repr)
    counts = {r[0]: r for r in out if r[0] in (8, 9)}
    assert len(out) == docs.count()
    assert [r[2:] for r in out if r[0] == 1] == [(1, True)] * 2 and (6, 6, 1, False) in out
    assert counts[8][2:] == (8, True) and counts[9][2:] == (8, False)
    assert (2, 0, 2, True) in out and (4, 0, 4, True) in out and (None, 0, None, True) in out and (None, 1, None, True) in out
    assert near_components(empty(spark)).collect() == []


def test_posterior_bounds():
    from math import comb

    for n, m in zip(range(STEP, HASHES + 1, STEP), least_matches(0.85, 1e-7)):
        above = lambda k: sum(comb(n + 1, i) * 0.85**i * 0.15 ** (n + 1 - i) for i in range(k + 1))  # noqa: B023, E731
        assert above(m) >= 1e-7 and (m == 0 or above(m - 1) < 1e-7)
    # Of a hundred thousand pairs at the threshold hardly one is dropped.
    rng = np.random.default_rng(0)
    equal = (rng.random((100_000, HASHES)) < 0.85).reshape(100_000, -1, STEP).sum(2).cumsum(1)
    assert (equal < np.array(least_matches(0.85, 1e-7))).any(1).sum() <= 3


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 4000, np.uint64)
    a, b = np.unique(base[:3000]), np.unique(base[300:3300])
    x, y = signatures([a, b])
    assert abs((x == y).mean() - 2700 / 3300) < 0.12
    assert abs(float(Fraction(2700, 3300)) - 0.818) < 0.001


def test_join_follows_chains():
    root = np.arange(9)
    _join(root, np.array([8, 6, 4, 2]), np.array([6, 4, 2, 0]))
    assert root.tolist() == [0, 1, 0, 3, 0, 5, 0, 7, 0]
