"""Every registered query agrees with its SQL in another engine."""

import pytest

from feira.queries import oracle_sql, queries
from tests.conftest import SMALL
from tools.compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    frame = queries()[name](spark, SMALL)
    assert compare(con, name, frame, oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())
