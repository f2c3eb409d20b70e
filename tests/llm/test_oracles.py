import compare
import pytest

from strata.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_query_matches_sql(spark, name):
    con = compare.connect(SF_DIR)
    assert compare.difference(queries.all_queries()[name](spark, SF_DIR), con, queries.all_oracles()[name]) is None
