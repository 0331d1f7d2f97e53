"""JSON texts as values: canonical form and digests, strict reading, RFC 6901 pointers, leaves. All are column functions that run in Arrow batches.

Spark's own reader of JSON keeps neither 1 and 1.0 apart nor the order of keys fixed, and sees no repeated keys; these do. A null text gives null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FAULT = "struct<kind:string,detail:string>"
FOUND = "struct<value:string,fault:string>"
LEAVES = "array<struct<pointer:string,leaf:string>>"


class _Refused(ValueError):
    def __init__(self, kind: str, detail: str) -> None:
        super().__init__(kind)
        self.kind, self.detail = kind, detail


def _per_value(f: Callable, returns: str, kind: pa.DataType) -> Callable[..., Column]:
    """A column function that applies f to each row's values; f sees no null in its first one."""

    @F.arrow_udf(returns)
    def run(first: pa.Array, *rest: pa.Array) -> pa.Array:
        others = [r.to_pylist() for r in rest]
        return pa.array([None if x is None else f(x, *(o[i] for o in others)) for i, x in enumerate(first.to_pylist())], kind)

    return run


def _load(text: str) -> Any:
    """The value, or _Refused; repeated keys and NaN are let through as the lenient readers of JSON do."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError) as e:
        raise _Refused("not_json", "") from e


def _canonical(value: Any, spaced: bool = False) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(", ", ": ") if spaced else (",", ":"))


def _written(text: str, spaced: bool = False) -> str | None:
    try:
        return _canonical(_load(text), spaced)
    except (_Refused, RecursionError):
        return None


def canonical(text: Column) -> Column:
    """The one form of a JSON text: keys sorted by code point, no spaces, letters as they are, whole numbers and fractions kept apart (1 and 1.0); null for what isn't JSON."""
    return _per_value(_written, "string", pa.string())(text)


def canonical_spaced(text: Column) -> Column:
    """The same with a space after each comma and colon, the form that instruments are digested in."""
    return _per_value(lambda t: _written(t, True), "string", pa.string())(text)


def canonical_id(prefix: str, text: Column, length: int = 24) -> Column:
    """prefix_ and the first digits of the SHA-256 of the canonical form."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(canonical(text).cast("binary"), 256), 1, length))


def fingerprint(**parts: Column) -> Column:
    """The SHA-256 of the canonical object that holds the parts; a null part is a null there, and sets go in sorted."""
    return F.sha2(canonical(F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]), {"ignoreNullFields": "false"})).cast("binary"), 256)


def instrument_id(**parts: Column) -> Column:
    """The MD5 of the spaced canonical object that holds the parts: results can be compared only where it is the same."""
    return F.md5(canonical_spaced(F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]), {"ignoreNullFields": "false"})).cast("binary"))


def _unique(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    out: dict[str, Any] = {}
    for key, value in pairs:
        if key in out:
            raise _Refused("duplicate_key", key)
        out[key] = value
    return out


def _no_constant(name: str) -> Any:
    raise _Refused("nonfinite_number", name)


def read_strictly(data: bytes) -> Any:
    """The value of UTF-8 JSON without repeated keys, NaN or infinities, or _Refused."""
    try:
        return json.loads(data.decode("utf-8"), object_pairs_hook=_unique, parse_constant=_no_constant)
    except _Refused:
        raise
    except UnicodeDecodeError as e:
        raise _Refused("not_utf8", str(e.start)) from e
    except (ValueError, RecursionError) as e:
        raise _Refused("not_json", "") from e


def _strict(data: bytes) -> dict[str, str] | None:
    try:
        read_strictly(data)
    except _Refused as e:
        return {"kind": e.kind, "detail": e.detail}
    return None


def strict_fault(content: Column) -> Column:
    """struct(kind, detail) of what keeps bytes from being strict JSON, null if nothing does: not_utf8 with the byte, not_json, duplicate_key with the key, nonfinite_number with its name."""
    return _per_value(_strict, FAULT, pa.struct([("kind", pa.string()), ("detail", pa.string())]))(content.cast("binary"))


def _index(token: str, size: int, strict: bool) -> int:
    if not (token.isascii() and token.isdigit()) or (strict and len(token) > 1 and token[0] == "0"):
        raise _Refused("bad_index", token)
    if int(token) >= size:
        raise _Refused("out_of_range", token)
    return int(token)


def _step(at: Any, token: str, strict: bool) -> Any:
    token = token.replace("~1", "/").replace("~0", "~")
    if isinstance(at, dict):
        if token not in at:
            raise _Refused("absent", token)
        return at[token]
    if isinstance(at, list):
        return at[_index(token, len(at), strict)]
    raise _Refused("through_scalar", token)


def _tokens(pointer: str, strict: bool) -> list[str]:
    if pointer == "" or (pointer == "/" and not strict):
        return []
    if not pointer.startswith("/"):
        raise _Refused("not_absolute", pointer)
    return (pointer[1:] if strict else pointer.lstrip("/")).split("/")


def _found(whole: Any, pointer: str | None, strict: bool) -> dict[str, str | None]:
    try:
        at = whole
        for token in _tokens(pointer or "", strict):
            at = _step(at, token, strict)
        return {"value": _canonical(at), "fault": None}
    except _Refused as e:
        return {"value": None, "fault": e.kind}


def _resolved(strict: bool) -> Callable[[str, str | None], dict[str, str | None]]:
    def resolve(text: str, pointer: str | None) -> dict[str, str | None]:
        try:
            return _found(_load(text), pointer, strict)
        except _Refused as e:
            return {"value": None, "fault": e.kind}

    return resolve


def at_pointer(text: Column, pointer: Column, strict: bool = False) -> Column:
    """struct(value, fault): the canonical JSON that an RFC 6901 pointer leads to, or why there is none; a null pointer is the whole.

    ~1 stands for a slash and ~0 for a tilde; "" is the whole document. Lenient, "/" is the whole too, slashes at the start count as one, and an index may begin with 0; strict, "/" is the key
    that is empty and such an index is bad_index. Else not_absolute, absent, out_of_range, through_scalar or not_json.
    """
    return _per_value(_resolved(strict), FOUND, pa.struct([("value", pa.string()), ("fault", pa.string())]))(text, pointer)


def at_pointers(text: Column, pointers: Column, strict: bool = False) -> Column:
    """What at_pointer gives for each of an array of pointers, in their order: the text is sent and read once for all of them. A null text or array gives null, an empty array an empty one."""

    @F.arrow_udf(f"array<{FOUND}>")
    def run(texts: pa.Array, asked: pa.Array) -> pa.Array:
        values, faults, ends = [], [], [0]
        missing = []
        for t, ps in zip(texts.to_pylist(), asked.to_pylist(), strict=True):
            missing.append(t is None or ps is None)
            if not missing[-1]:
                try:
                    whole, refused = _load(t), None
                except _Refused as e:
                    whole, refused = None, e.kind
                for p in ps:
                    found = _found(whole, p, strict) if refused is None else {"value": None, "fault": refused}
                    values.append(found["value"])
                    faults.append(found["fault"])
            ends.append(len(values))
        found = pa.StructArray.from_arrays([pa.array(values, pa.string()), pa.array(faults, pa.string())], ["value", "fault"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found, mask=pa.array(missing))

    return run(text, pointers)


def _walk(value: Any) -> Iterator[tuple[str, str]]:
    """(pointer, text) of each leaf, in the document's order, without recursion."""
    todo = [("", value)]
    while todo:
        pointer, at = todo.pop()
        if isinstance(at, dict):
            todo += reversed([(f"{pointer}/{k.replace('~', '~0').replace('/', '~1')}", v) for k, v in at.items()])
        elif isinstance(at, list):
            todo += reversed([(f"{pointer}/{i}", v) for i, v in enumerate(at)])
        elif at is not None:
            yield pointer, at if isinstance(at, str) else str(at)


def _leaves(text: str) -> list[dict[str, str]] | None:
    try:
        return [{"pointer": p, "leaf": v} for p, v in _walk(_load(text))]
    except _Refused:
        return None


def leaves(text: Column) -> Column:
    """The strings, numbers and truth values of a JSON text of any depth with the pointer to each, in order; nulls are no leaves; null for what isn't JSON."""
    return _per_value(_leaves, LEAVES, pa.list_(pa.struct([("pointer", pa.string()), ("leaf", pa.string())])))(text)


def _object(data: bytes) -> dict[str, str | None]:
    """What a response of metadata states of itself, or what is wrong with it."""
    none = {"kind": None, "detail": None, "sha": None, "id": None, "model_id": None}
    try:
        value = read_strictly(data)
    except _Refused as e:
        return none | {"kind": e.kind, "detail": e.detail}
    if not isinstance(value, dict):
        return none | {"kind": "not_an_object"}
    said = {name: None if value.get(key) is None else value[key] if isinstance(value[key], str) else _canonical(value[key]) for name, key in (("sha", "sha"), ("id", "id"), ("model_id", "modelId"))}
    return none | said


def stated_identity(content: Column) -> Column:
    """struct(kind, detail, sha, id, model_id) of strict JSON bytes: kind as strict_fault has it, or not_an_object; else what they say of their own revision and repository."""
    names = ("kind", "detail", "sha", "id", "model_id")
    return _per_value(_object, "struct<" + ",".join(f"{n}:string" for n in names) + ">", pa.struct([(n, pa.string()) for n in names]))(content.cast("binary"))
