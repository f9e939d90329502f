import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardflow.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4, app_name="wardflow-tests",
                  extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of plain tuples, optionally sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r)) if order is None else out
