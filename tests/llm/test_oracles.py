"""The queries with a DuckDB form against it, and the registry."""

import pytest

from pulseboard.llm.queries import ORACLES, QUERIES
from pulseboard.oracle.compare import compare, duckdb_connection

from ..conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF001), duckdb_connection(SF001), ORACLES[name])
    assert res["ok"], res


def test_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 1 + len(QUERIES)))
