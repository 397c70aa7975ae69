"""Every registered query equals its DuckDB twin on the smallest driver tables."""

import pytest

from provdata.plans.registry import load_all
from tests.conftest import SF_SMALL

QUERIES = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    from tools.check_oracle import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    from tools.check_oracle import compare
    msgs, _ = compare(spark, con, load_all()[name], SF_SMALL)
    assert not msgs, msgs
