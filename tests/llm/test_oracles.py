"""Queries of the package that have SQL, against it."""

import pytest
from check import compare, duck

from lakeops.llm.queries import ORACLES, QUERIES
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    verdict = compare(QUERIES[name](spark, SF).toArrow(), duck(SF).sql(ORACLES[name]).to_arrow_table())
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict
