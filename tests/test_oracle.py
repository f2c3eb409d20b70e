"""Every registered query against its SQL, over whole tables."""

import compare
import pytest

import __spark_entry__ as entry_module
from workload.oracles import all_oracles
from workload.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_module.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_returns_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "track_id" and df.count() > 0
