import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle_check import differences, duck_connection
from tidewire.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


def test_all_operators_are_registered():
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(spark, duck_connection(FOLDER), FOLDER, name) is None
