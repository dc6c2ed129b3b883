"""The SQL twins of the operators' queries."""
import pytest
from oracle_compare import compare, duck

from sparkguard.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    r = compare(spark, name, sf, duck(sf))
    assert r.get("hash_match"), r
