"""Rules, reconciliation, drift, run log, registry."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators import governance as gov
from lakeops.operators import quality as dq
from lakeops.operators.aggregate import cube_kpi, list_parts, numeric_profile, pivot_sum, rollup_kpi
from lakeops.operators import sets
from lakeops.schemas import JOB_RUNS
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def dirty(spark):
    data = [(1, 5.0), (1, 5.0), (None, 5.0), (2, None), (3, 0.0), (4, -1.0), (5, float("nan")), (None, -2.0)]
    return spark.createDataFrame(data, "id int, amount double")


def rules():
    return {**dq.not_null_rules(["id"]), **dq.positive_rule("amount")}


def test_split_keeps_copies_and_names_rules(dirty):
    good, bad = dq.split_rules(dirty, rules())
    assert rows(good) == [(1, 5.0), (1, 5.0)]
    failed = [r[dq.FAILED] for r in bad.collect()]
    assert len(failed) == 6 and ["id_not_null", "amount_positive"] in failed
    assert "Exchange" not in plan(good)


def test_rules_reach_the_scan(tables):
    good, _ = dq.split_rules(tables.events, {**dq.not_null_rules(["user_id"]), **dq.positive_rule("value")})
    assert "GreaterThan(value,0.0)" in plan(good) and "IsNotNull(user_id)" in plan(good)


def test_metrics_in_one_pass(dirty):
    m = dq.rule_metrics(dirty, rules())
    assert m.first().asDict() == {
        "input_rows": 8, "good_rows": 2, "dq_failed_rows": 6, "failed_id_not_null": 2, "failed_amount_positive": 5,
    }
    assert plan(m).count("Scan ExistingRDD") <= 2  # once in the tree, once in the details


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0), (None, 1.0)], "k int, v double")
    out = {r["check"]: (r["source_value"], r["target_value"], r["ok"]) for r in dq.reconcile(a, b, ["k"], {"v": F.sum("v")}).collect()}
    assert out == {
        "rows": (3.0, 4.0, False), "v": (6.0, 6.0, True), "duplicate_keys": (0.0, 1.0, False),
        "missing_keys": (0.0, 1.0, False), "unexpected_keys": (0.0, 1.0, False),
    }
    assert all(r["ok"] for r in dq.reconcile(a, a, ["k"], {"v": F.sum("v")}).collect())


def test_schema_drift(spark):
    a = spark.createDataFrame([], "a int, b string, c long").schema
    b = spark.createDataFrame([], "a int, b int, d date").schema
    assert rows(dq.schema_drift(spark, a, b).select("column_name", "change")) == [("b", "retyped"), ("c", "removed"), ("d", "added")]


def test_run_log_has_one_schema(spark, folder):
    log = folder()
    with gov.job_run(spark, log, "batch", "a", "b") as run:
        run.input_rows = 1
    with pytest.raises(KeyError), gov.job_run(spark, log, "stream", "a", "b", 7):
        raise KeyError("x")
    back = gov.runs(spark, log)
    assert back.columns == JOB_RUNS.fieldNames() and back.count() == 2
    assert not gov.batch_done(spark, log, "stream", 7) and gov.batch_done(spark, log, "batch", 0) is False
    with gov.job_run(spark, log, "stream", "a", "b", 7):
        pass
    assert gov.batch_done(spark, log, "stream", 7)


def test_registry_adds_only_changes(spark, folder):
    path, a = folder(), spark.createDataFrame([], "a int").schema
    b = spark.createDataFrame([], "a long").schema
    assert [gov.snapshot_schema(spark, s, "t", "p", path) for s in (a, a, b, b, a)] == [True, False, True, False, True]


def test_sets_with_nulls_and_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert rows(sets.except_all(a, b)) == [(1,), (None,)]
    assert rows(sets.minus(a, b)) == [(None,)]
    assert rows(sets.intersect(a, a)) == [(1,), (None,)]
    assert rows(sets.union_distinct(a, b)) == [(1,), (None,)]
    assert plan(sets.minus(a, b)).count("Exchange hash") <= 2


def test_union_by_position_refuses_swapped_columns(spark):
    a = spark.createDataFrame([("x", "y")], "p string, q string")
    with pytest.raises(ValueError):
        sets.union_all(a, a.select("q", "p"))


def test_list_parts_cut_large_groups(spark):
    df = spark.range(1000).select((F.col("id") % 2 * F.col("id") % 3).alias("k"), "id")
    out = list_parts(df, ["k"], "id", ["id"], part_size=100)
    assert out.agg(F.max("n_items")).first()[0] == 100
    for key in (0, 1, 2):
        got = [i for r in out.filter(F.col("k") == key).orderBy("part").collect() for i in r["items"]]
        assert got == [i for i in range(1000) if i % 2 * i % 3 == key]


def test_pivot_and_rollup_edge_cases(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", None, 2.0), (None, "x", 4.0), ("b", "y", None)], "k string, c string, v double")
    assert rows(pivot_sum(df, ["k"], "c", ["x", "absent"], "v")) == [("a", 1.0, None), ("b", None, None), (None, 4.0, None)]
    levels = rows(rollup_kpi(df, ["k", "c"], "v"))
    assert (None, None, 3, 4, 7.0) in levels and (None, None, 1, 1, 4.0) in levels and ("a", None, 0, 1, 2.0) in levels
    assert cube_kpi(df, ["k", "c"], "v").filter("level = 2").count() == 3


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 20011])
def test_exact_quantiles(spark, n):
    df = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(n)) / 8).alias("a"), F.when(F.col("id") % 3 == 0, F.lit(5)).alias("b"), F.lit(None).cast("int").alias("c")
    )
    pdf = df.toPandas()
    out = {r["column_name"]: r for r in numeric_profile(df, ["a", "b", "c"], (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
    for p, name in ((0, "p0"), (0.1, "p10"), (0.5, "p50"), (0.99, "p99"), (1.0, "p100")):
        assert out["a"][name] == pytest.approx(pdf.a.quantile(p), abs=1e-9)
    assert out["b"]["p50"] == 5 and out["c"]["p50"] is None and out["c"]["n_null"] == n


def test_profile_of_tiny_and_huge_values(spark):
    df = spark.createDataFrame([(0.0004995, 1e16), (0.0004995, 3e16)], "a double, b double")
    out = {r["column_name"]: r for r in numeric_profile(df, ["a", "b"], (0.5,)).collect()}
    assert out["a"]["mean"] == pytest.approx(4.995e-4, rel=1e-12) and out["b"]["mean"] == 2e16 and out["b"]["p50"] == 2e16


def test_error_text_is_logged_whole(spark, folder):
    from lakeops.operators import governance as gov

    log = folder("log")
    with pytest.raises(ValueError):
        with gov.job_run(spark, log, "a b/c", "s", "t", 7):
            raise ValueError("x" * 5000)
    assert len(gov.runs(spark, log).first()["error_message"]) > 5000 and not gov.batch_done(spark, log, "a b/c", 7)
    with gov.job_run(spark, log, "a b/c", "s", "t", 7):
        pass
    assert gov.batch_done(spark, log, "a b/c", 7) and not gov.batch_done(spark, log, "a b/c", 8)


def test_observed_rules_are_those_of_the_write(dirty, folder):
    watched, seen = dq.observed_rules(dirty, rules())
    watched.write.parquet(folder())
    assert seen.get == dq.rule_metrics(dirty, rules()).first().asDict()
    none, seen = dq.observed_rules(dirty.limit(0), rules())
    none.write.parquet(folder())
    assert set(seen.get.values()) == {0}


def test_changed_rows_names_what_differs(spark):
    kind = "k int, a string, b string"
    source = [(1, "x", None), (2, None, "y"), (3, "z", "z"), (3, "z", "z"), (4, "q", "q"), (None, "n", "n"), (5, "p", "r"), (5, "s", "t"), (6, "same", None)]
    # Key 1 has its value in the other column, 5 has the same rows in another order.
    target = [(1, None, "x"), (2, None, "y"), (3, "z", "z"), (None, "n", None), (5, "s", "t"), (5, "p", "r"), (7, "new", "n"), (6, "same", None)]
    a, b = spark.createDataFrame(source, kind), spark.createDataFrame(target, kind)
    want = [(1, "changed", 1, 1), (3, "count", 2, 1), (4, "missing", 1, 0), (7, "unexpected", 0, 1), (None, "changed", 1, 1)]
    for buckets in (1, 7, 65_536):
        assert rows(dq.changed_rows(a, b.select("b", "k", "a"), ["k"], buckets)) == sorted(want, key=repr)
    assert dq.changed_rows(a, a.repartition(3), ["k"]).count() == 0 and dq.changed_rows(a.limit(0), a.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError):
        dq.changed_rows(a, b.drop("b"), ["k"])
    with pytest.raises(ValueError):
        dq.changed_rows(a, b.withColumn("k", F.col("k").cast("long")), ["k"])


def test_changed_rows_shuffles_rows_of_open_buckets_only(spark):
    text = plan(dq.changed_rows(spark.range(1000).selectExpr("id", "id * 2 AS v"), spark.range(1000).selectExpr("id", "id * 2 AS v"), ["id"]))
    # Rows meet the few open buckets before the exchange by key.
    assert "BroadcastHashJoin LeftSemi" in text and "SortMergeJoin" not in text


def test_governed_day_reads_its_day_once(spark, folder, monkeypatch):
    from pyspark.sql import Observation

    from lakeops.plans.kpi import governed_day

    silver, registry, log = folder("silver"), folder("registry"), folder("log")
    day = spark.range(100).selectExpr("'d1' AS dt", "id % 3 AS k", "CAST(id AS DOUBLE) AS amount", "id AS other")
    day.write.partitionBy("dt").parquet(silver)

    def run(gold):
        return governed_day(spark, silver, gold, "d1", [], ["k"], "amount", log, registry)

    again = []
    count = type(day).agg
    monkeypatch.setattr(type(day), "agg", lambda df, *a: (again.append(1) if "other" in df.columns else None, count(df, *a))[1])
    assert all(r["ok"] for r in run(folder("gold")).collect()) and not again
    # What tasks that ran twice would report: the day is counted again, and the run succeeds.
    monkeypatch.setattr(Observation, "get", property(lambda _: {"t": 101, "a": 1.0}))
    assert all(r["ok"] for r in run(folder("gold")).collect()) and len(again) == 1
    assert [r["input_rows"] for r in gov.runs(spark, log).collect()] == [100, 100]
