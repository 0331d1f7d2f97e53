import pytest

from cardloom.plans import cards, catalogue, claims, jsons, papers
from tests.sql_check import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalogue.SQL) if cards and claims and jsons and papers else [])
def test_query_equals_its_sql(spark, con, name):
    same(spark, con, catalogue.QUERIES[name], catalogue.SQL[name], SF)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["quote_id", "source_id", "start", "end"]


def test_numbers_canonical(spark):
    from pyspark.sql import functions as F

    from cardloom.functions import text as T

    df = spark.createDataFrame([("7B and 1,024 tokens, 4.5 million, v2x 3K",)], "t string")
    assert df.select(T.canonical_numbers(F.col("t"))).first()[0] == [7e9, 1024.0, 4.5e6, 3000.0]
    assert catalogue.QUERIES["numbers_canonical"](spark, SF).where("n < 1").count() == 0
