import pytest

from quire.llm import registry

from ..oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert differences(spark, connect(SF), registry.queries()[name], registry.oracle_sql()[name], SF) == ""
