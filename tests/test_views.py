"""The DataFrame views equal the SQL text of the views (run by DuckDB)."""

import pytest

from conftest import SF_SMALL
from oracle_util import duck, same
from wardflow.checks.views_sql import VIEWS
from wardflow.sources.synthetic import tables


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", list(VIEWS))
def test_view(spark, con, name):
    t = tables(spark, SF_SMALL)
    ok, a, b = same(t.get(name), con, f"SELECT * FROM ({VIEWS[name]})")
    assert ok, (name, len(a[1]), len(b[1]))
