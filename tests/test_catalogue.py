"""Every query of the library against its SQL, at the smallest scale."""

import pytest
from oracle import SF_DIR, of_duckdb, of_spark

from cairn.plans import catalogue

ORACLES = catalogue.oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    columns, rows = of_spark(catalogue.queries()[name](spark, SF_DIR))
    want_columns, want = of_duckdb(ORACLES[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(ORACLES)))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SF_DIR).collect()
