import random
from itertools import combinations

import pytest

from lakeops.llm import chosen_path as cp
from tests.conftest import SF
from tests.llm.cases import TEXTS, edge, empty, unchanged


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(class, text, links, text links) of every row number, by comparing all sets."""
    sets = {}
    for n, (i, t) in enumerate(rows):
        sets.setdefault(grams(t) or n, []).append(n)
    keys = [s for s in sets if not isinstance(s, int)]
    near = {s: [] for s in keys}
    for a, b in combinations(keys, 2):
        both = len(a & b)
        if both and 9 * both >= 4 * (len(a) + len(b)):
            near[a].append(b)
            near[b].append(a)
    least = lambda ns: min((rows[n][0] for n in ns if rows[n][0] is not None), default=None)
    out, seen = {}, set()
    for s in sets:
        if isinstance(s, int):
            out[s] = (rows[s][0], rows[s][0], 0, 0)
        elif s not in seen:
            part, todo = set(), [s]
            while todo:
                x = todo.pop()
                if x not in part:
                    part.add(x)
                    todo += near[x]
            seen |= part
            whole = least([n for x in part for n in sets[x]])
            for x in part:
                for n in sets[x]:
                    out[n] = (whole, least(sets[x]), len(sets[x]) - 1 + sum(len(sets[y]) for y in near[x]), len(near[x]))
    return sorted(((rows[n][0], *v) for n, v in out.items()), key=repr)


def found(frame, **options):
    return sorted(((r.doc_id, r.class_id, r.text_id, r.n_links, r.n_text_links) for r in cp.linked(frame, **options).collect()), key=repr)


def test_edge_cases(spark):
    docs = edge(spark)
    assert found(docs) == brute(TEXTS)
    kept = cp.one_of_each(docs)
    unchanged(kept, docs)
    # The three copies and the two long texts each leave one row.
    assert kept.count() == len(TEXTS) - 3
    assert cp.linked(empty(spark)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("small, dense", [(16, 0.75), (16, 2.0)])
def test_large_nodes_split_or_compared_in_blocks(spark, monkeypatch, small, dense):
    """A dense group, a chain, texts that share a passage, and copies; with nodes far above the limit."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = []
    for i in range(120):
        t = list(base)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(120)] = word()
        rows.append(" ".join(t))
    rows += [" ".join(passage + [word() for _ in range(rng.randrange(5, 60))]) for _ in range(120)]
    chain = [word() for _ in range(80)]
    for i in range(40):
        chain = chain[2:] + [word(), word()]
        rows.append(" ".join(chain))
    rows += ["one two"] * 50 + [" ".join(base)] * 30
    rows = list(enumerate(rows))
    monkeypatch.setattr(cp, "SMALL", small)
    monkeypatch.setattr(cp, "BLOCK", 8)
    monkeypatch.setattr(cp, "DEPTH", 2)
    monkeypatch.setattr(cp, "DENSE", dense)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got, expected = found(frame), brute(rows)
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert got == expected


def test_runs_for_the_recall():
    assert cp.runs_for(0.9, 0.8) < cp.runs_for(0.9999, 0.8) <= 4
    assert cp.met(0.8, 1) == pytest.approx(0.96) and cp.met(0.8, 7) > 0.93
