"""JSON values, row spans and quotas at their edges; the queries compare the rest with SQL."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cardloom.functions import jsons
from cardloom.operators import facts, metadata, sampling, tables


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"b":1,"a":{"d":[1.0,1e2,"é\\u0000"],"c":null}}', '{"a":{"c":null,"d":[1.0,100.0,"é\\u0000"]},"b":1}'),
        ("12345678901234567890123", "12345678901234567890123"),
        ('{"a":1,"a":2}', '{"a":2}'),
        ("{", None),
        ("", None),
        (None, None),
        ("[" * 100_000, None),
    ],
)
def test_canonical(spark, text, want):
    assert one(spark, jsons.canonical(F.col("t")), t=text) == want


@pytest.mark.parametrize(
    "data,want",
    [
        (b'{"a":{"a":1}}', None),
        (b'[{"a":1},{"a":1}]', None),
        (b'{"a":[{"k":1,"k":1}]}', ("duplicate_key", "k")),
        (b"[Infinity]", ("nonfinite_number", "Infinity")),
        (b'"NaN"', None),
        (b'{"a":"\xe9"}', ("not_utf8", "6")),
        (b"nul", ("not_json", "")),
        (b"[" * 50_000, ("not_json", "")),
    ],
)
def test_strict_reading(spark, data, want):
    got = one(spark, jsons.strict_fault(F.col("t")), t=data)
    assert (None if got is None else tuple(got)) == want


def test_pointers_and_leaves_of_odd_values(spark):
    assert tuple(one(spark, jsons.at_pointer(F.col("t"), F.col("p"), True), t="[1]", p=None)) == ("[1]", None)
    assert tuple(one(spark, jsons.at_pointer(F.col("t"), F.col("p"), True), t='{"":{"":7}}', p="//")) == ("7", None)
    assert tuple(one(spark, jsons.at_pointer(F.col("t"), F.col("p")), t="no", p="/a")) == (None, "not_json")
    assert tuple(one(spark, jsons.at_pointer(F.col("t"), F.col("p")), t='{"~1":3}', p="/~01")) == ("3", None)
    assert [tuple(x) for x in one(spark, jsons.leaves(F.col("t")), t='[true,[2.50,{"~/":"x"}],null,{}]')] == [("/0", "True"), ("/1/0", "2.5"), ("/1/1/~0~1", "x")]
    assert [tuple(x) for x in one(spark, jsons.leaves(F.col("t")), t="3")] == [("", "3")]
    assert one(spark, jsons.leaves(F.col("t")), t="{") is None
    deep = "[" * 900 + "5" + "]" * 900
    assert one(spark, jsons.leaves(F.col("t")), t=deep)[0]["pointer"] == "/0" * 900


def test_ids_follow_content(spark):
    a, b = (one(spark, jsons.canonical_id("bind", F.col("t")), t=json.dumps(x)) for x in ({"x": 1, "y": 2}, {"y": 2, "x": 1}))
    assert a == b != one(spark, jsons.canonical_id("bind", F.col("t")), t='{"x":1.0,"y":2}')


def test_metadata_without_content(spark):
    rows = [("a", "m", "r", "ok", None, 0), ("b", "m", "r", "ok", b'{"id":5}', None), ("c", "m", "r", "gated", b"{}", 0), ("d", "m", "r", "ok", b"{}", 9)]
    df = spark.createDataFrame(rows, "target string, model_id string, revision string, status string, content binary, bytes_before long")
    got = {r["target"]: (r["outcome"], r["fault"]) for r in metadata.metadata_records(df, 100, 10).collect()}
    assert got == {"a": ("refused", "not_json"), "b": ("refused", "repository_drift"), "c": ("gated", None), "d": ("size_limited", None)}


def test_identifiers(spark):
    text = "OLMo-2-1124-7B, GSM8K and MMLU-Pro by meta/llama; a mid-trained Transformer-style net, v2, on 2024-01"
    assert one(spark, facts.identifiers(F.col("t")), t=text) == ["gsm8k", "meta/llama", "mmlupro", "olmo211247b"]
    v = spark.createDataFrame([(1, '{"a":["GSM8K",{"b":"12"}]}', "on gsm8k-hard", []), (2, None, None, None), (3, "plain 55", None, None)], "binding_id int, value string, evidence string, established array<string>")
    assert sorted(map(tuple, facts.unsupported_leaves(v).collect())) == [(1, "12.0"), (3, "55.0")]


def test_row_spans_never_overlap(spark):
    sources = spark.createDataFrame([(1, "aaaaaa bb aaaaaa"), (2, None)], "source_id int, text string")
    asked = [(0, 1, "aaaaaa", "aa", 0, 2), (1, 1, "aaaaaa", "aa", 0, 3), (2, 1, "aaaaaa", "aaaa", 1, 0), (3, 1, "aaaaaa", "aaaa", 1, 1), (4, 2, "a", "a", 0, 0), (5, 1, None, "a", 0, 0), (6, 1, "a", "a", 0, -1)]
    df = spark.createDataFrame(asked, "request_id int, source_id int, block string, row string, nth_block int, nth_row int")
    got = {r["request_id"]: (r["start"], r["end"], r["fault"]) for r in tables.row_spans(df, sources).collect()}
    assert got == {0: (4, 6, None), 1: (None, None, "row_absent"), 2: (10, 14, None), 3: (None, None, "row_absent"), 4: (None, None, "block_absent"), 5: (None, None, "empty_text"), 6: (None, None, "negative_occurrence")}


def dealt(cells, size):
    order = sorted(cells, key=lambda c: (-c[1], c[0]))
    total, out = sum(n for _, n in cells), {}
    for k, n in order:
        out[k] = max(0, min(n, max(1, round(size * n / total)), size - sum(out.values())))
    while sum(out.values()) < min(size, total):
        for k, n in order:
            if out[k] < n and sum(out.values()) < size:
                out[k] += 1
    return out


def test_quotas_sum_to_the_size(spark):
    rng = random.Random(4)
    for _ in range(8):
        cells = [(f"c{i}", rng.choice([1, 2, 3, 40, 500])) for i in range(rng.randint(1, 12))]
        size = rng.choice([1, 3, 20, 60, 5000])
        got = sampling.apportioned(spark.createDataFrame(cells, "k string, n long"), ["k"], size).collect()
        assert {r["k"]: r["quota"] for r in got} == dealt(cells, size)


def test_a_draw_of_nothing_and_of_all(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(10)], "id int, s string")
    assert sampling.drawn(rows.where("id > 99"), "id", ["s"], 5, "q").collect() == []
    assert sampling.drawn(rows, "id", ["s"], 50, "q").count() == 10
    assert sampling.drawn(rows, "id", ["s"], 7, "q").count() == 7
