import pytest

from cardloom.llm import queries
from tests.sql_check import connect, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, connect(SF), queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
