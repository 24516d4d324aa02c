import pytest

from quire.queries import registry

from .oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, registry.queries()[name], registry.oracle_sql()[name], SF) == ""
