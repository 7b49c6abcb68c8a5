"""Every registered query against its SQL, or for rows where it has none."""

import pytest

from oracle import compare, connect
from tidemark.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
