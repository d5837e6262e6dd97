import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, difference
from sheafline.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) == ""


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert {int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")} == set(range(1, 14))
