import random

from lakeops.llm.components import components


def test_against_search(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for n in sorted(near):
        if n not in expected:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in expected:
                    expected[x] = n
                    todo += near[x]
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()]
    assert sorted(got) == sorted(expected.items())


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
