"""Every registered query against its SQL twin on the smallest data set."""

import pytest

from casework import plans
from tests.conftest import SF
from tools.check import compare, connect

ORACLES = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    _, problems = compare(plans.queries()[name](spark, SF), con, ORACLES[name])
    assert not problems, problems


@pytest.mark.parametrize("name", [n for n in plans.queries() if n not in ORACLES])
def test_gives_rows(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0


def test_entry_is_flagship(spark):
    from __spark_entry__ import entry

    assert {"q_id", "id", "reranker_score", "rank"} <= set(entry(spark).columns)
