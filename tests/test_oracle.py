"""Every registered query against DuckDB on the same Parquet tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from fleetlake.plans.registry import all_queries  # noqa: E402
from oracle import oracle_queries  # noqa: E402


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, small, connection, name):
    status, _, detail = compare(spark, connection, small, name, all_queries()[name], oracle_queries().get(name))
    assert status in ("ok", "rows"), detail
    assert "TYPES" not in detail, detail


def test_every_oracle_has_a_query():
    assert set(oracle_queries()) <= set(all_queries())
