"""Plans of queries whose tables grow: what is as large as its input is sent to no driver, and heavy rows are dealt over all tasks."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from cardloom.functions import jsons

D = "/root/testdata/sf0.001"


def _plan(spark, name):
    return __spark_entry__.queries()[name](spark, D)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["score_rows_of_targets", "score_claims"])
def test_nothing_is_broadcast(spark, name):
    assert "Broadcast" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["paper_titles", "family_generations"])
def test_heavy_rows_are_dealt(spark, name):
    assert __spark_entry__.queries()[name](spark, D).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize(("name", "most"), [("paper_titles", 40_000), ("paper_choice", 40_000), ("own_repositories", 12_000), ("family_generations", 20_000)])
def test_a_name_is_taken_apart_once(spark, name, most):
    assert len(_plan(spark, name)) < most


@pytest.mark.parametrize("name", ["target_aliases", "json_pointers", "publication_faults"])
def test_rows_of_one_small_file_are_dealt(spark, name):
    assert __spark_entry__.queries()[name](spark, D).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["table_row_spans", "leaf_support"])
def test_rows_are_dealt_before_they_meet(spark, name):
    plan = _plan(spark, name)
    assert "REPARTITION_BY_NUM" in plan and "Broadcast" not in plan


def test_pointers_of_one_text(spark):
    rows = spark.createDataFrame([('{"a":[1,{"b":null}]}', ["", "/a/1/b", "/a/9", None]), ("{", ["", "/a"]), (None, ["/a"]), ("1", []), ("1", None)], "t string, p array<string>")
    found = [r.x and [(y.value, y.fault) for y in r.x] for r in rows.select(jsons.at_pointers(F.col("t"), F.col("p")).alias("x")).collect()]
    whole = ('{"a":[1,{"b":null}]}', None)
    assert found == [[whole, ("null", None), (None, "out_of_range"), whole], [(None, "not_json")] * 2, None, [], None]
