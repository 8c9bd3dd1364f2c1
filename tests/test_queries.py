"""Every query against its SQL in DuckDB, on the smallest scale."""

import pytest
from check import compare, duck

from lakeops.queries import ORACLES, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert name in ORACLES
    verdict = compare(got, con.sql(ORACLES[name]).to_arrow_table())
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()
