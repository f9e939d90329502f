"""Every query with an oracle equals its DuckDB SQL (on sf0.001 here; the
driver runs the same comparison on sf0.01)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_util import duck, same

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, a, b = same(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert a[0] == b[0], (name, a[0], b[0])
    assert ok, (name, len(a[1]), len(b[1]), sorted(set(a[1]) - set(b[1]))[:3], sorted(set(b[1]) - set(a[1]))[:3])


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["subject_id", "hadm_id"] and len(df.columns) == 30
    assert df.count() > 0
