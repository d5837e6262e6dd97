import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, difference
from sheafline.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


#: Approximate: compared with the exact search in test_ann.
WITHOUT_SQL = {"vector_topk_ann"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["document_id", "chunk_count"] and df.count() > 0
