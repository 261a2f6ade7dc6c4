import pytest

from oracle import difference
from placelake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, name, "/root/testdata/sf0.01") is None
