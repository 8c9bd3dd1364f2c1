import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import mixing
from lakeops.llm.queries import DOMAIN, QUERIES, TARGETS
from tests.llm.cases import TEXTS, edge, empty, unchanged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = mixing.learned(docs, labels.filter("doc_id % 3 != 0"), F.expr(DOMAIN))
    keys = docs.select("doc_id", F.monotonically_increasing_id().alias("row"))
    truth = labels.filter("doc_id % 3 = 0").select("doc_id", F.expr(DOMAIN).alias("d"))
    rows = mixing.posteriors(docs, model).join(keys, "row").join(truth, "doc_id").collect()
    right = sum(model.domains[int(np.argmax(r.p))] == r.d for r in rows)
    assert right >= 0.8 * len(rows) > 80
    assert all(sum(r.p) == pytest.approx(1) for r in rows)


def test_totals_match_the_targets(spark):
    out = QUERIES["op10_soft_mixing"](spark, SF).toPandas()
    tokens = {d: (out.n_tokens * out[f"p_{d}"]).sum() for d in TARGETS}
    mixed = {d: (out.rate * out.n_tokens * out[f"p_{d}"]).sum() for d in TARGETS}
    assert (out.rate >= 0).all() and len(out) == 1000
    assert mixed["good"] == pytest.approx(tokens["good"], rel=1e-4)
    for d, w in TARGETS.items():
        assert mixed[d] / sum(mixed.values()) == pytest.approx(w, abs=1e-4)
    assert abs(out.copies - out.rate).max() < 1
    assert (out.copies * out.n_tokens).sum() == pytest.approx((out.rate * out.n_tokens).sum(), rel=0.05)


def test_rates_are_the_least_squares_solution(spark):
    """Against a plain projected gradient over all rows in memory, with and without reachable targets."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    tokens = rng.integers(1, 400, 300)
    frame = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))], "row long, tokens long, p array<double>").coalesce(1)
    now = (tokens[:, None] * p).sum(0)
    for target, miss in ((now * [1.0, 0.3, 2.0], 1e-5), (now * [1.0, 0.01, 0.01], 1e-5), (np.array([1.0, 0.0, 0.0]) * now.sum(), 0.03)):
        out = mixing.fitted(frame, target).toPandas().sort_values("row")
        got = (out.rate.to_numpy()[:, None] * tokens[:, None] * p).sum(0)
        r = np.ones(300)
        a = (tokens[:, None] * p).T
        for _ in range(5000):
            r = np.maximum(0, r - a.T @ (a @ r - target) / np.linalg.norm(a, 2) ** 2)
        assert np.linalg.norm(got - target) <= np.linalg.norm(a @ r - target) + miss * now.sum()


def test_edge_cases(spark, tables):
    docs, labels = tables
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    rows = mixing.mixed_rates(edge(spark), model, TARGETS).collect()
    assert len(rows) == len(TEXTS) and all(r.rate >= 0 and r.copies >= 0 for r in rows)
    assert sorted(r.tokens for r in rows)[:4] == [0, 0, 0, 0]
    out = mixing.mixed(edge(spark), model, {"good": 1, "poor": 1, "toxic": 1}, tokens=1e7)
    unchanged(out, edge(spark))
    assert out.count() > len(TEXTS)
    assert mixing.mixed(empty(spark), model, TARGETS).collect() == []


def test_nothing_learned(spark):
    none = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = mixing.learned(edge(spark), none, F.expr(DOMAIN))
    assert model.domains == []
    assert {(r.rate, r.copies) for r in mixing.mixed_rates(edge(spark), model, TARGETS).collect()} == {(1.0, 1)}


def test_steady_rates_are_not_drawn(spark, tables):
    docs, labels = tables
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    rows = mixing.mixed_rates(docs, model, TARGETS, keep="good", steady=0.2).filter("abs(rate - 1) <= 0.2")
    assert rows.count() > 400 and rows.filter("copies != 1").count() == 0


def test_spared_documents_stay(spark, tables):
    docs, labels = tables
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    rows = mixing.mixed_rates(docs, model, {"good": 0.2, "toxic": 0.8}, spare="good").collect()
    good = [r for r in rows if model.domains[int(np.argmax(r.p))] == "good"]
    assert len(good) > 500 and all(r.rate >= 1 and r.copies >= 1 for r in good)
    assert any(r.rate < 0.5 for r in rows)


def test_small_rates_are_drawn_not_dropped(spark, folder):
    """The stage's options, with a domain whose rates are below `steady`: the kept tokens match the targets."""
    rng = np.random.default_rng(6)
    parts = [("good", 6000), ("toxic", 3000), ("poor", 1000)]
    domains = rng.permutation([d for d, n in parts for _ in range(n)])
    rows = [(i, " ".join(f"{d}{w}" for w in rng.integers(0, 40, 20)), str(d)) for i, d in enumerate(domains)]
    path = folder("domains")
    spark.createDataFrame(rows, "doc_id long, text string, d string").coalesce(2).write.parquet(path)
    docs = spark.read.parquet(path)
    labels = docs.filter("doc_id < 600").selectExpr("doc_id", "int(d != 'poor') AS quality", "int(d = 'toxic') AS toxic")
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    options = {"keep": "good", "steady": 0.1, "spare": "good"}
    rates = mixing.mixed_rates(docs, model, TARGETS, **options).toPandas()
    toxic = np.array(rates.p.tolist()).argmax(1) == model.domains.index("toxic")
    assert toxic.sum() == 3000 and rates.rate[toxic].max() < 0.1
    kept = {r.d: r.n for r in mixing.mixed(docs, model, TARGETS, **options).groupBy("d").agg(F.count("*").alias("n")).collect()}
    for d, w in TARGETS.items():
        assert kept.get(d, 0) / sum(kept.values()) == pytest.approx(w, abs=0.004)


def test_a_repeated_key_teaches_once(spark, monkeypatch):
    """Keys repeated in documents and labels: one row of features for each key comes to the driver."""
    seen = []
    real = mixing._trained
    monkeypatch.setattr(mixing, "_trained", lambda names, slots, counts, domain: seen.append(len(counts)) or real(names, slots, counts, domain))
    docs = spark.range(600).selectExpr("IF(id < 200, 0, id) AS doc_id", "concat('some words ', id) AS text")
    labels = spark.range(600).selectExpr("IF(id < 50, 0, id) AS doc_id", "IF(id % 2 = 0, 'a', 'b') AS d")
    mixing.learned(docs, labels, F.col("d"))
    assert seen == [401]
