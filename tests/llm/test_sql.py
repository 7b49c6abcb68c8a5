"""Every query that has SQL against it; every operator of the list is registered once."""

import pytest

from oracle import compare, connect
from tidemark.llm.catalog import LLM_ORACLES, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, LLM_QUERIES[name], LLM_ORACLES[name], SF_DIR) is None


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)
