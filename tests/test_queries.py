import pytest

import __spark_entry__ as entry_point
from oracle import difference
from placelake.plans import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert name in entry_point.oracle_sql()
    assert difference(spark, name, SF) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "neighborhood_id" and df.count() == 25
