"""Every query of the package that has SQL matches DuckDB (sf 0.001); all of them run there."""

import pytest

from ledgerlens.llm.registry import load_all
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck, type_mismatches

QUERIES, ORACLE = load_all()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duck(SF_SMALL)
    sdf = QUERIES[name](spark, SF_SMALL)
    ok, msg = compare(sdf.toPandas(), con.execute(ORACLE[name]).df())
    assert ok, msg
    assert not type_mismatches(sdf.dtypes, con, ORACLE[name])


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
