"""The queries that SQL can express, against that SQL over whole tables."""

import pytest
from oracle import SF_DIR, of_duckdb, of_spark

from cairn.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    columns, rows = of_spark(queries.QUERIES[name](spark, SF_DIR))
    want_columns, want = of_duckdb(queries.ORACLES[name])
    assert columns == want_columns
    assert rows == want
