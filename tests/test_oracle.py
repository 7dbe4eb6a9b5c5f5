"""Every registered query against its DuckDB oracle on the small fixture
(the driver runs the same check at sf0.01)."""

import pytest

import __spark_entry__ as entry
from lampwatch.plans import catalog, oracle
from tests.conftest import SF_SMALL
from tests.verify import compare, duck


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, list(catalog.QUERIES), con=duck(SF_SMALL))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r.get("error")
    if r["oracle"]:
        assert r["columns_match"], r
        assert r["rows"] == r["oracle_rows"], r
        assert r["values_match"], r


def test_every_query_has_oracle():
    assert set(oracle.SQL) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sensor_key" in df.columns
