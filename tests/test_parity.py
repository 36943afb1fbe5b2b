"""Every registered query against its SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from parity import compare, connect

SF = "/root/testdata/sf0.001"


#: The training-data queries are tested in their own folder.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None
