"""Every registered query with an oracle matches DuckDB on the same parquet tables (sf 0.001)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck, type_mismatches

import __spark_entry__ as E

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    got = sdf.toPandas()
    want = con.execute(ORACLE[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg
    assert not type_mismatches(sdf.dtypes, con, ORACLE[name])


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total"] > 0
    assert df.columns == ["positives", "negatives", "total", "positive_pct", "negative_pct"]
