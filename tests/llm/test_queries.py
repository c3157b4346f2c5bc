import os

import pytest

from tessera.llm import queries
from tests import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), queries.queries()[name], queries.oracle_sql()[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_returns_a_row_for_each_input(spark, name):
    table = "pages" if name == "op10_html_text" else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    got = queries.queries()[name](spark, SF)
    key = "page_id" if table == "pages" else "doc_id"
    assert got.select(key).distinct().count() == n and (name == "op2_packing" or got.count() == n)
