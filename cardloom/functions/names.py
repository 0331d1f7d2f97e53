"""Column expressions over model names, repository paths, statuses and declared values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes of one parameter by data type, modalities by pipeline tag, outcomes by status.
DTYPE_BYTES = {"F64": 8, "F32": 4, "BF16": 2, "F16": 2, "F8_E4M3": 1, "F8_E5M2": 1, "I8": 1, "U8": 1, "F8": 1, "I32": 4, "I64": 8, "BOOL": 1, "I16": 2}
MODALITIES = {
    "text-generation": ("input: text", "output: text"),
    "text2text-generation": ("input: text", "output: text"),
    "image-text-to-text": ("input: image, text", "output: text"),
    "automatic-speech-recognition": ("input: audio", "output: text"),
    "image-to-text": ("input: image", "output: text"),
    "text-to-image": ("input: text", "output: image"),
}
OUTCOMES = {200: "ok", 401: "authentication_required", 403: "gated", 404: "missing", 413: "too_large", 408: "unavailable", 409: "unavailable", 425: "unavailable", 429: "unavailable"}
# Suffixes of a training stage.
STAGE_SUFFIX = r"(?i)[-_ ]+(instruct|chat|it|sft|dpo|rl|rlvr|thinking|base|pt)$"


def _map(values: dict) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])


def outcome(status: Column) -> Column:
    """What an HTTP status means for a source; any other below 500 is a protocol error."""
    return F.coalesce(F.element_at(_map(OUTCOMES), status.cast("int")), F.when(status >= 500, "unavailable").otherwise("protocol_error"))


def size_contradicts(total_bytes: Column, parameters: Column, dtype: Column) -> Column:
    """True if the bytes are more than one and a half times what so many parameters of the type take; unknown types contradict nothing."""
    width = F.element_at(_map(DTYPE_BYTES), F.upper(dtype))
    return F.coalesce((parameters > 0) & (total_bytes > parameters * width * 1.5), F.lit(False))


def modalities(tag: Column) -> Column:
    return F.array(F.element_at(_map({k: v[0] for k, v in MODALITIES.items()}), tag), F.element_at(_map({k: v[1] for k, v in MODALITIES.items()}), tag))


def pair_stem(name: Column) -> Column:
    """A name without the suffix of its training stage."""
    return F.regexp_replace(name, STAGE_SUFFIX, "")


def stage(name: Column) -> Column:
    """post, base or null, by the name's suffix."""
    token = F.lower(F.regexp_extract(name, STAGE_SUFFIX, 1))
    return F.when(token.isin("base", "pt"), "base").when(token != "", "post")


def card_name(model_id: Column) -> Column:
    return F.lower(F.substring_index(model_id, "/", -1))


def distinctive_tokens(name: Column) -> Column:
    """Words of a name of three letters or more that are no number, size or stage."""
    return F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda t: (F.length(t) >= 3) & ~t.rlike(r"^\d+([bm]|\.\d+[bm])?$") & ~t.isin("instruct", "chat", "base", "sft", "dpo", "model", "the"))


def declared(value: Column) -> Column:
    """A declared value without quotes; words for nothing, values over 256 signs and unprintable ones are null."""
    v = F.trim(F.regexp_replace(F.trim(value), "^[\"']|[\"']$", ""))
    return F.when(F.lower(v).isin("", "null", "none", "~", "n/a") | (F.char_length(v) > 256) | v.rlike(r"\p{Cntrl}"), None).otherwise(v)


def media_type(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.endswith(".json"), "application/json").when(low.endswith(".md"), "text/markdown").when(low.rlike(r"\.html?$"), "text/html").otherwise("text/plain")


def relevant_file(name: Column, allowed: list[str], tokens: list[str]) -> Column:
    """An allowed JSON file, or a text file whose stem holds one of the tokens."""
    base = F.lower(F.substring_index(name, "/", -1))
    return base.isin(*allowed) | (base.rlike(r"^[^.]+(\.(md|txt))?$") & F.substring_index(base, ".", 1).rlike("|".join(tokens)))


def short(text: Column, most: int = 120) -> Column:
    """White space collapsed, cut with an ellipsis."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.char_length(t) > most, F.concat(F.left(t, F.lit(most - 1)), F.lit("…"))).otherwise(t)


def field_path(path: Column) -> Column:
    """struct(base, indexes) of "section.field[1][2]"; null if it is no such path."""
    good = path.rlike(r"^[a-z_]+\.[a-z_]+(\[\d+\])*$")
    return F.when(good, F.struct(F.regexp_extract(path, r"^([a-z_]+\.[a-z_]+)", 1).alias("base"), F.transform(F.regexp_extract_all(path, F.lit(r"\[(\d+)\]"), 1), lambda x: x.cast("int")).alias("indexes")))


def set_at(values: Column, index: Column, value: Column) -> Column:
    """A list with one place replaced, or one value put at its end; a gap is an error."""
    n = F.size(values)
    return F.when(index < n, F.transform(values, lambda x, i: F.when(i == index, value).otherwise(x))).when(index == n, F.array_append(values, value)).otherwise(F.raise_error(F.lit("the index leaves a gap")).cast("array<string>"))


def remove_at(values: Column, index: Column) -> Column:
    """A list without one place; an emptied list becomes the sign of absence."""
    rest = F.filter(values, lambda x, i: i != index)
    return F.when(F.size(rest) == 0, F.array(F.lit("Not specified"))).otherwise(rest)


def escape_markdown(text: Column) -> Column:
    """HTML signs as entities, Markdown signs behind a backslash, line ends as breaks."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(text, r"([\\`*_\[\]|])", r"\\$1"), r"\r?\n", "<br>")
