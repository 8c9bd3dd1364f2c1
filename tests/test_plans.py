"""Plans of the headline queries: pruning, pushdown, join node, number of exchanges."""

import contextlib
import io

import pytest

from lakeops.queries import QUERIES
from tests.conftest import SF, plan


def tree(spark, name) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF).explain()
    return out.getvalue()


def test_flagship(spark):
    text = plan(QUERIES["pip02_period_kpi"](spark, SF))
    assert "BroadcastHashJoin" in text and "GreaterThanOrEqual(o_orderdate,1996-01-01" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "partial_sum" in text and "o_orderkey" not in text


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [("agg03_kpi", 1), ("agg10_pivot", 1), ("agg20_one_exchange", 1), ("agg07_rollup", 2), ("set06_minus", 1), ("set08_intersect", 1),
     ("jon10_bucketed", 0), ("pip02_period_kpi", 2), ("win04_latest_per_key", 1), ("fun26_tokens", 0), ("dq01_split", 0)],
)
def test_exchanges(spark, name, exchanges):
    text = tree(spark, name)
    assert text.count("Exchange ") - text.count("BroadcastExchange ") == exchanges, text


@pytest.mark.parametrize("name", ["jon04_broadcast", "jon05_broadcast_sql_hint", "jon06_size_threshold", "jon11_star", "pip01_enrich_silver"])
def test_broadcast(spark, name):
    assert "BroadcastHashJoin" in tree(spark, name) and "SortMergeJoin" not in tree(spark, name)


def test_day_filter_prunes(spark):
    assert "PartitionFilters: [isnotnull(month" in tree(spark, "flt06_day_keeps_pruning")
    assert "PartitionFilters: [isnotnull(month" in tree(spark, "src03_partition_filter")


def test_raw_column_predicate_is_pushed(spark):
    assert "PushedFilters: [IsNotNull(c_mktsegment)" in plan(QUERIES["flt07_raw_column_predicate"](spark, SF))


def test_top_k_is_not_a_sort(spark):
    for name in ("srt03_top_k", "agg17_skew_profile"):
        assert "TakeOrderedAndProject" in tree(spark, name)


def test_no_python_workers(spark):
    for name in ("fun06_event_hash", "fun25_masking", "fun26_tokens", "str01_envelope_parse", "dq01_split"):
        assert "Python" not in tree(spark, name)
