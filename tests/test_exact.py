"""Exact totals against rational arithmetic, under any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.functions.exact import mean, total
from lakeops.functions.money import exact_sum
from lakeops.operators.aggregate import daily_kpi, kpi, pivot_sum, sum_where
from lakeops.queries import ORACLES, QUERIES


def frame(spark, values, n=3):
    return spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, x double").repartition(n)


def test_thousandths_tiny_and_huge(spark):
    one = lambda values: frame(spark, values).agg(total("x").alias("t"), mean("x").alias("m")).first()
    assert one([0.004] * 1000).t == 4.0
    assert one([1e17, 1e-17, -1e17]).t == 1e-17
    assert one([0.1] * 10).t == 1.0
    assert one([2.0**59, 1.0, -(2.0**59), 2.0**-68]).t == 1.0 + 2.0**-68
    assert one([None, None]).t is None and one([None, 3.0]).m == 3.0
    assert one([-0.004, -0.004, 0.0]).t == -0.008


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=-(2.0**59), max_value=2.0**59).map(lambda v: 0.0 if abs(v) < 2.0**-60 else v), min_size=1, max_size=60))
def test_nearest_double_of_the_rational_sum(spark, values):
    want = float(sum(map(Fraction, values)))
    for n in (1, 4):
        assert frame(spark, values, n).agg(total("x").alias("t")).first().t == want


def test_groups_under_any_partitioning(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 15) for _ in range(4000)]
    want = {k: float(sum(Fraction(v) for i, v in enumerate(values) if i % 2 == k)) for k in (0, 1)}
    for n in (1, 7, 40):
        got = frame(spark, values, n).groupBy("k").agg(total("x").alias("t")).collect()
        assert {r.k: r.t for r in got} == want


def test_nan_and_infinite_amounts_show(spark):
    out = frame(spark, [float("nan"), float("inf"), 5.0, 5.0]).groupBy("k").agg(total("x").alias("t"), mean("x").alias("m")).collect()
    out = {r.k: (r.t, r.m) for r in out}
    assert math.isnan(out[0][0]) and math.isnan(out[0][1]) and out[1] == (float("inf"), float("inf"))


@pytest.mark.parametrize("value", [2.0**60, 2.0**-121, 1e300])
def test_amounts_beyond_the_places_are_refused(spark, value):
    with pytest.raises(Exception, match="no exact sum"):
        frame(spark, [1.0, value]).agg(total("x")).collect()


def test_amounts_finer_than_the_scale_and_nan_are_refused_by_units(spark):
    for value in (0.004, float("nan"), float("inf")):
        with pytest.raises(Exception, match="whole minor units"):
            frame(spark, [1.0, value]).agg(exact_sum("x")).collect()
    assert frame(spark, [0.1, 0.07, 19.99, 123456789.01, None]).agg(exact_sum("x").alias("t")).first().t == 123456809.17


def test_operators_with_unscaled_amounts(spark):
    rows = frame(spark, [0.004] * 2000).withColumn("ts", F.lit("2026-01-01").cast("timestamp"))
    assert {(r.k, r.txns, r.total_amount, r.avg_amount) for r in kpi(rows, ["k"], "x", None).collect()} == {(k, 1000, 4.0, 0.004) for k in (0, 1)}
    assert daily_kpi(rows, "ts", [], "x", None).first().total_amount == 8.0
    assert rows.agg(sum_where(F.col("k") == 1, "x", None).alias("t")).first().t == 4.0
    assert tuple(pivot_sum(rows, ["ts"], "k", [0, 1, 2], "x", None).first())[1:] == (4.0, 4.0, None)
    assert {"agg03_kpi_exact", "pip02_exact_kpi"} <= QUERIES.keys() & ORACLES.keys()
