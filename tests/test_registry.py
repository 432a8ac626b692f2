"""Every registered query against its DuckDB oracle, on the smallest tables."""

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from corvid import catalog
from corvid.plans.compare import compare_frames, duckdb_connection

QUERIES = catalog.queries()
ORACLES = catalog.oracles()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle_and_back():
    assert set(ORACLES) == set(QUERIES)
    assert len(QUERIES) == 43
    assert QUERIES.keys() <= se.queries().keys()
    assert ORACLES.keys() <= se.oracle_sql().keys()


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["product", "popularity"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    ok, msg = compare_frames(got, want)
    assert ok, msg
    for col in want.columns:
        kinds = [{type(x) for x in pdf[col] if x is not None} for pdf in (got, want)]
        assert str(got[col].dtype) == str(want[col].dtype), (col, got[col].dtype, want[col].dtype)
        if got[col].dtype == object and kinds[0] & {str, bool, int, float}:
            assert kinds[0] == kinds[1], (col, kinds)

