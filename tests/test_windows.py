"""Distributed numbering against pandas, with hot groups, ties and nulls."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeops.operators import windows as win
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows on one key, a third of them with one order value; some null keys."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(np.arange(n) % 3 < 2, 1, rng.integers(2, 200, n)).astype(float)
    key[::97] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "o": np.where(np.arange(n) % 4 == 0, 7, rng.integers(0, 50, n)), "v": rng.integers(0, 1000, n)})
    df = spark.createDataFrame(pdf.astype({"id": "int64", "o": "int64", "v": "int64"}))
    df = df.withColumn("k", F.when(~F.isnan("k"), F.col("k")).cast("long")).repartition(7)
    return df, pdf.assign(k=pdf.k.fillna(-1))


def expected(pdf):
    pdf = pdf.sort_values(["k", "o", "id"])
    g = pdf.groupby("k")
    return pdf.assign(
        rn=g.cumcount() + 1,
        run=g.v.cumsum(),
        lag=g.v.shift(1),
        lead=g.v.shift(-1),
        rk=g.o.rank("min").astype(int),
        drk=g.o.rank("dense").astype(int),
    ).sort_values("id")


@pytest.mark.parametrize("all_large", [False, True])
def test_numbers_match_pandas(skewed, all_large):
    df, pdf = skewed
    out = win.ordered_numbers(
        df, ["k"], ["o", "id"], row_number="rn", running={"run": "v"}, lag={"lag": "v"}, lead={"lead": "v"}, all_large=all_large
    )
    got = out.toPandas().sort_values("id")
    want = expected(pdf)
    assert list(got.rn) == list(want.rn)
    assert list(got.run) == list(want.run)
    for c in ("lag", "lead"):
        assert np.array_equal(got[c].astype(float), want[c].astype(float), equal_nan=True)


def test_no_keys_is_one_group(skewed):
    df, pdf = skewed
    got = win.ordered_numbers(df, [], ["-o", "-id"], row_number="rn").toPandas().sort_values("id")
    want = pdf.sort_values(["o", "id"], ascending=False).assign(rn=range(1, len(pdf) + 1)).sort_values("id")
    assert list(got.rn) == list(want.rn)


def test_ranks_match_pandas(skewed):
    df, pdf = skewed
    got = win.ranks(df, ["k"], ["o"], rank="rk", dense_rank="drk").toPandas().sort_values("id")
    want = expected(pdf)
    assert list(got.rk) == list(want.rk)
    assert list(got.drk) == list(want.drk)


def test_large_groups_are_found(skewed):
    df, _ = skewed
    assert [r[0] for r in win._large_groups(df, ["k"], 4).collect()] == [1]
    assert win._large_groups(df.filter("k <> 1"), ["k"], 4) is None


def test_latest_ties_and_nulls(spark):
    data = [
        (1, "2024-01-01", None, "a"), (1, "2024-01-01", "2024-01-02", "b"),  # a value beats a null ingest time
        (2, None, "2024-01-09", "c"), (2, "2024-01-01", None, "d"),  # a null event time is oldest
        (3, "2024-01-01", "2024-01-01", "e"), (3, "2024-01-01", "2024-01-01", "f"),  # full tie: one row, always the same
    ]
    df = spark.createDataFrame(data, "id int, event_ts string, ingest_ts string, v string")
    one = rows(win.latest(df, ["id"], ["event_ts", "ingest_ts"]).select("id", "v"))
    two = rows(win.latest(df.repartition(5).orderBy("v"), ["id"], ["event_ts", "ingest_ts"]).select("id", "v"))
    assert one == two and one[:2] == [(1, "b"), (2, "d")] and len(one) == 3


def test_top_n_and_latest_are_cut_before_the_exchange(skewed):
    df, _ = skewed
    for made in (win.latest(df, ["k"], ["o"]), win.top_n(df, ["k"], ["-v"], 3, "dense_rank")):
        assert "WindowGroupLimit" in plan(made)


def test_keep_takes_all_ties(spark):
    df = spark.createDataFrame([(1, 5, 10), (1, 5, 30), (1, 4, 99), (2, None, 8), (2, 1, 7)], "k int, o int, v int")
    out = df.groupBy("k").agg(win.keep_last_max("o", "v").alias("hi"), win.keep_first_min("o", "v").alias("lo"))
    assert rows(out) == [(1, 30, 99), (2, 7, 7)]


def test_keep_with_null_among_ties(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, None), ("c", None, 3.0)], "k string, o int, v double")
    got = df.groupBy("k").agg(win.keep_first_min("o", "v").alias("lo"), win.keep_last_max("o", "v").alias("hi"))
    assert rows(got) == [("a", 5.0, 1.0), ("b", None, None), ("c", None, None)]


def test_latest_with_maps(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1, "b": 2}), (1, 1, {"a": 1, "b": 3}), (2, 1, None)], "k int, o int, m map<string, int>")
    first = rows(win.latest(df, ["k"], ["o"]))
    assert len(first) == 2 and first == rows(win.latest(df.orderBy("m.b"), ["k"], ["o"]))
