"""JSON Schema compiled to column expressions: what a document breaks, as rows of path and rule.

A schema is a dict of the keywords type, enum, const, pattern, minLength, format (uri), minItems, maxItems, uniqueItems, items, required, properties, additionalProperties, anyOf, allOf, $ref. It becomes one
expression over a VARIANT, built once on the driver; nothing interprets the schema while rows go by, and no Python runs in tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import jsons
from cardloom.functions.text import let as _let
from cardloom.operators.gates import FIELDS

Schema = dict[str, Any]
_FAULTS = "array<struct<path:string,rule:string>>"
#: What schema_of_variant calls the values of each JSON type.
_KINDS = {"string": "^STRING$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "boolean": "^BOOLEAN$", "null": "^VOID$", "array": "^ARRAY", "object": "^OBJECT"}
_URI = r"^[A-Za-z][A-Za-z0-9+.\-]*:[^\s<>\"{}|\\^`]*$"


def _none() -> Column:
    return F.array().cast(_FAULTS)


def _fault(broken: Column, path: Column, rule: str) -> Column:
    return F.when(broken, F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(_FAULTS)).otherwise(_none())


def _escaped(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def compiled(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    """array<struct<path, rule>> of what value, a VARIANT that isn't SQL null, breaks of schema."""
    if "$ref" in schema:
        at: Any = root
        for token in schema["$ref"].removeprefix("#/").split("/"):
            at = at[token]
        return compiled(at, value, path, root)
    parts = [rule(schema, value, path, root) for keys, rule in _RULES if any(k in schema for k in keys)]
    return F.concat(*parts) if parts else _none()


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).rlike(_KINDS[kind])


def _type(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    return _fault(~_is(value, schema["type"]), path, "type")


def _enum(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    allowed = [json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for x in schema.get("enum", [schema.get("const")])]
    return _fault(~F.to_json(value).isin(*allowed), path, "enum" if "enum" in schema else "const")


def _strings(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    def rules(text: Column) -> Column:
        parts = [_fault(F.char_length(text) < schema["minLength"], path, "minLength")] if "minLength" in schema else []
        parts += [_fault(~text.rlike(schema["pattern"]), path, "pattern")] if "pattern" in schema else []
        parts += [_fault(~text.rlike(_URI), path, "format")] if schema.get("format") == "uri" else []
        return F.concat(*parts) if parts else _none()

    return F.when(_is(value, "string"), _let(F.try_variant_get(value, "$", "string"), rules)).otherwise(_none())


def _arrays(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    def rules(items: Column) -> Column:
        parts = [_fault(F.size(items) < schema["minItems"], path, "minItems")] if "minItems" in schema else []
        parts += [_fault(F.size(items) > schema["maxItems"], path, "maxItems")] if "maxItems" in schema else []
        texts = F.transform(items, lambda x: F.to_json(x))
        parts += [_fault(F.size(F.array_distinct(texts)) < F.size(items), path, "uniqueItems")] if schema.get("uniqueItems") else []
        if "items" in schema:
            each = F.transform(items, lambda x, i: compiled(schema["items"], x, F.concat(path, F.lit("/"), i.cast("string")), root))
            parts.append(F.flatten(each))
        return F.concat(*parts)

    return F.when(_is(value, "array"), _let(F.try_variant_get(value, "$", "array<variant>"), rules)).otherwise(_none())


def _objects(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    below = lambda key: F.concat(path, F.lit(f"/{_escaped(key)}"))
    escaped = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))

    def of_member(of: Schema, key: str) -> Callable[[Column], Column]:
        return lambda member: compiled(of, member, below(key), root)

    def rules(members: Column) -> Column:
        keys = F.map_keys(members)
        parts = [_fault(~F.array_contains(keys, key), below(key), "required") for key in schema.get("required", ())]
        for key, of in schema.get("properties", {}).items():
            member = _let(F.try_element_at(members, F.lit(key)), of_member(of, key))
            parts.append(F.when(F.array_contains(keys, key), member).otherwise(_none()))
        if schema.get("additionalProperties") is False:
            more = F.array_except(keys, F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>"))
            parts.append(F.transform(more, lambda k: F.struct(F.concat(path, F.lit("/"), escaped(k)).alias("path"), F.lit("additionalProperties").alias("rule"))).cast(_FAULTS))
        return F.concat(*parts) if parts else _none()

    return F.when(_is(value, "object"), _let(F.try_variant_get(value, "$", "map<string,variant>"), rules)).otherwise(_none())


def _any_of(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    """If no branch fits: what the first branch of the value's own type finds wrong, or one row here if there is none."""

    def rules(found: Column) -> Column:
        told, fits = _fault(F.lit(True), path, "anyOf"), F.lit(False)
        for i, branch in reversed(list(enumerate(schema["anyOf"]))):
            fits = fits | (F.size(found[f"b{i}"]) == 0)
            if "type" in branch:
                told = F.when(_is(value, branch["type"]), found[f"b{i}"]).otherwise(told)
        return F.when(fits, _none()).otherwise(told)

    return _let(F.struct(*[compiled(b, value, path, root).alias(f"b{i}") for i, b in enumerate(schema["anyOf"])]), rules)


def _all_of(schema: Schema, value: Column, path: Column, root: Schema) -> Column:
    return F.concat(*[compiled(branch, value, path, root) for branch in schema["allOf"]])


_RULES: list[tuple[tuple[str, ...], Callable[[Schema, Column, Column, Schema], Column]]] = [
    (("type",), _type),
    (("enum", "const"), _enum),
    (("minLength", "pattern", "format"), _strings),
    (("minItems", "maxItems", "uniqueItems", "items"), _arrays),
    (("required", "properties", "additionalProperties"), _objects),
    (("anyOf",), _any_of),
    (("allOf",), _all_of),
]


def schema_faults(documents: DataFrame, schema: Schema) -> DataFrame:
    """(key, path, rule) of documents(key, json): a row for each place where a document breaks the schema, the path an RFC 6901 pointer.

    Text that isn't JSON, null too, has one row of rule not_json, and text with repeated keys or NaN one of not_strict, at the whole. Where no branch of an anyOf fits, the faults of the
    branch of the value's type are told, or one anyOf. Numbers are equal for uniqueItems if they are written alike, so 1 and 1.0 differ there. Documents that break nothing give no row.
    """
    strict = jsons.strict_fault(F.col("json"))
    rows = documents.select("key", F.col("json"), strict.alias("_strict"))
    rows = rows.select("key", F.when(F.col("_strict").isNull(), F.try_parse_json("json")).alias("v"), F.col("_strict.kind").alias("_kind"))
    broken = F.when(F.col("v").isNotNull(), _let(F.col("v"), lambda v: compiled(schema, v, F.lit(""), schema)))
    unread = _fault(F.lit(True), F.lit(""), "not_strict")
    unread = F.when(F.col("_kind").isin("duplicate_key", "nonfinite_number"), unread).otherwise(_fault(F.lit(True), F.lit(""), "not_json"))
    return rows.select("key", F.explode(F.coalesce(broken, unread)).alias("f")).select("key", "f.path", "f.rule")


def field_faults(values: DataFrame, schema: Schema) -> DataFrame:
    """(key, field, path, rule) of values(key, field, json): each checked against the part of the schema that its field names as section.field, or one item of a list as section.field[n].

    The whole of a value has the path "". unknown_field: the schema has no such field, or the name isn't of this form; not_a_list: an index into a field that takes no list. A field's rules are
    compiled once, and a row is tried against those of its own field only.
    """
    rows = values.select("key", "field", F.when(jsons.strict_fault(F.col("json")).isNull(), F.try_parse_json("json")).alias("v"))
    name, v = F.regexp_replace("field", r"\[(0|[1-9]\d*)\]$", "[]"), F.col("v")
    found = F.when(F.col("v").isNull(), _fault(F.lit(True), F.lit(""), "not_json"))
    for field, part in _fields(schema).items():
        items = next((b["items"] for b in part.get("anyOf", [part]) if "items" in b), None)
        found = found.when(name == field, compiled(part, v, F.lit(""), schema))
        found = found.when(name == f"{field}[]", _fault(F.lit(True), F.lit(""), "not_a_list") if items is None else compiled(items, v, F.lit(""), schema))
    found = found.otherwise(_fault(F.lit(True), F.lit(""), "unknown_field"))
    return rows.select("key", "field", F.explode(found).alias("f")).select("key", "field", "f.path", "f.rule")


def _fields(schema: Schema) -> dict[str, Schema]:
    out = {}
    for section, of in schema["properties"].items():
        out |= {f"{section}.{name}": part for name, part in of.get("properties", {}).items()}
    return out


# ---- the publication contract ----

# The words for absence, and the relations of the two lists of models.
ABSENT = ("Not specified", "Not applicable")
RELATIONS = {"base_models": "base_model", "derivatives": "derivative_model"}
_SOLID: Schema = {"type": "string", "minLength": 1, "pattern": r"\S"}
_MODEL_ID: Schema = {"type": "string", "pattern": r"^[^/@\s]+(?:/[^/@\s]+)+$"}


def _or_absent(schema: Schema) -> Schema:
    return {"anyOf": [schema, {"enum": list(ABSENT)}]}


def _closed(required: list[str], properties: dict[str, Schema]) -> Schema:
    return {"type": "object", "required": required, "properties": properties, "additionalProperties": False}


def _several(of: Schema) -> Schema:
    return {"anyOf": [{"type": "array", "items": of, "minItems": 1, "uniqueItems": True}, {"enum": list(ABSENT)}]}


def _model(relation: str) -> Schema:
    return _closed(["model_id", "relation"], {"model_id": _MODEL_ID, "relation": {"const": relation}, "kind": _SOLID, "version": _SOLID})


def publication_schema() -> Schema:
    """The contract of a public card: eight closed sections, all required, of the 34 fields, any of which may be left out; each is a text or what its kind asks for, or one of the words for absence."""
    special: dict[str, Schema] = {f"lineage.{name}": _several(_model(relation)) for name, relation in RELATIONS.items()}
    special["identity.model_id"] = _or_absent(_MODEL_ID)
    special["specifications.input_output"] = _several(_SOLID)
    score = {"anyOf": [{"type": "number"}, _SOLID]}
    special["evaluation.benchmark_scores"] = _several(_closed(["benchmark", "metric", "score", "setting"], {"benchmark": _SOLID, "metric": _SOLID, "score": score, "setting": _SOLID, "split": _SOLID}))
    link = {"type": "string", "format": "uri", "minLength": 1}
    special["risks.possible_risks"] = _several(_closed(["category", "description"], {"category": _SOLID, "description": _SOLID, "url": {"anyOf": [link, {"type": "null"}]}, "justification": _SOLID}))
    special |= {f"links.{name}": _or_absent(link) for name in FIELDS["links"] if name != "citation"}
    sections = {s: _closed([], {f: special.get(f"{s}.{f}", _or_absent(_SOLID)) for f in fs}) for s, fs in FIELDS.items()}
    return _closed(list(sections), sections)
