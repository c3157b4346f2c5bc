import os

import pytest

from tessera.plans import registry
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, con, name):
    sql = registry.oracle_sql().get(name)
    assert sql is not None
    assert oracle.compare(spark, con, registry.queries()[name], sql, SF) is None
