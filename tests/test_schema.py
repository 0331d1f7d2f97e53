"""The schema compiler at its edges; the queries hold each rule of the contract against SQL."""

from cardloom.operators.schema import field_faults, publication_schema, schema_faults


def faults(spark, schema, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, json string")
    return sorted(map(tuple, schema_faults(docs, schema).collect()))


def test_types_and_limits(spark):
    schema = {
        "$defs": {"n": {"type": "integer"}},
        "type": "object",
        "properties": {"a": {"type": "array", "items": {"type": "array", "maxItems": 2, "items": {"$ref": "#/$defs/n"}}}, "b": {"allOf": [{"type": "boolean"}, {"const": True}]}, "c": {"type": "null"}, "d": {"enum": [1, "x"]}},
    }
    good = '{"a":[[1,2],[]],"b":true,"c":null,"d":"x","more":[{}]}'
    assert faults(spark, schema, good, "{}", '{"d":1}') == []
    assert faults(spark, schema, '{"a":[[1,2,3],5,["x",1.5]],"b":false,"c":0,"d":2}') == [
        (0, "/a/0", "maxItems"), (0, "/a/1", "type"), (0, "/a/2/0", "type"), (0, "/a/2/1", "type"), (0, "/b", "const"), (0, "/c", "type"), (0, "/d", "enum")
    ]


def test_nothing_and_no_json(spark):
    schema = {"type": "object", "required": ["x"]}
    assert faults(spark, schema, None, "", "[1]", '{"x":1,"x":2}', '{"x":null}') == [(0, "", "not_json"), (1, "", "not_json"), (2, "", "type"), (3, "", "not_strict")]
    assert faults(spark, schema) == []
    assert faults(spark, {}, "5") == []


def test_keys_that_need_escapes(spark):
    schema = {"type": "object", "properties": {"it's": {"type": "string"}, "a.b": {"type": "string"}}, "additionalProperties": False}
    assert faults(spark, schema, '{"it\'s":1,"a.b":"x","~/":0}') == [(0, "/it's", "type"), (0, "/~0~1", "additionalProperties")]


def test_sections_may_lack_fields_but_not_be_missing(spark):
    contract = publication_schema()
    assert [r for _, _, r in faults(spark, contract, "{" + ",".join(f'"{s}":{{}}' for s in contract["properties"]) + "}")] == []
    assert len(faults(spark, contract, "{}")) == 8
    values = spark.createDataFrame([(1, None, '"x"'), (2, "identity.name", None), (3, "x", "1")], "key int, field string, json string")
    assert sorted((r["key"], r["rule"]) for r in field_faults(values, contract).collect()) == [(1, "unknown_field"), (2, "not_json"), (3, "unknown_field")]
