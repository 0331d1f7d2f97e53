"""Values that need no model: facts with a literal needle in frozen text, and support of a value's parts by its evidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import jsons
from cardloom.functions import text as T


def structured_facts(sources: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(target, field, value, needle, at) for each rule field: (value, needle) whose needle stands literally in the source's text.

    sources(target, text, ...) has one row for each target; a rule whose value or needle is null, or whose needle is not there, gives no fact.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"), n.cast("string").alias("needle")) for f, (v, n) in rules.items()])
    rows = sources.select("target", "text", F.explode(cells).alias("c")).select("target", "text", "c.*").where("value is not null and needle is not null")
    return rows.withColumn("at", F.expr("instr(text, needle)") - 1).where("at >= 0").drop("text")


# The model types that are decoder-only by name.
DECODER_TYPES = ("llama", "gpt2", "qwen2", "qwen3")


def architecture(config: dict[str, Column]) -> Column:
    """The kind of a model by its configuration (model_type, architecture and experts, any key that counts experts); the first that fits decides, null if none does."""
    kind = F.lower(F.coalesce(config["model_type"], F.lit("")))
    arch = F.lower(F.coalesce(config["architecture"], F.lit("")))
    return (
        F.when(F.coalesce(config["experts"].cast("long"), F.lit(0)) != 0, "mixture-of-experts")
        .when(kind.contains("mamba") | arch.contains("mamba"), "state-space")
        .when(arch.contains("forcausallm") | kind.isin(*DECODER_TYPES), "dense decoder-only")
        .when(kind.contains("whisper") | arch.contains("encoderdecoder") | arch.contains("objectdetection"), "encoder-decoder")
        .when(kind.contains("diffusion") | arch.contains("diffusion"), "diffusion")
    )


# What may be an identifier, and how it is folded.
CANDIDATE = r"(?U)\b(?:[A-Za-z0-9][\w.]*/[\w.\-]+|[A-Za-z][\w.]*(?:[-_][A-Za-z0-9][\w.]*)+|[A-Za-z]+\d[\w.]*)\b"
NOT_FOLDED = "[^a-z0-9/]"


def identifiers(text: Column) -> Column:
    """The identifiers of a text, folded, sorted: repository ids, and names that have a digit or a capital within; a word that is only compounded names nothing."""
    plain, any_script = (F.lit(f"({x})") for x in (CANDIDATE.removeprefix("(?U)"), CANDIDATE))  # alike on ASCII, where the first is quicker
    found = T.let(F.coalesce(text, F.lit("")), lambda t: F.when(t.rlike(r"^\p{ASCII}*$"), F.regexp_extract_all(t, plain, 1)).otherwise(F.regexp_extract_all(t, any_script, 1)))
    named = F.filter(found, lambda t: (F.char_length(t) >= 3) & (t.contains("/") | t.rlike(r"\p{Nd}") | F.regexp_replace(t, "[-_]", "").rlike("^.+[A-Z]")))
    folded = F.transform(named, lambda t: F.regexp_replace(F.lower(t), NOT_FOLDED, ""))
    return F.array_sort(F.array_distinct(F.filter(folded, lambda t: (t != "") & ~t.rlike(r"^\d+$"))))


def leaf_text(value: Column) -> Column:
    """All leaves of a JSON value as one text; a value that isn't JSON is its own text."""
    return F.coalesce(F.array_join(F.transform(jsons.leaves(value), lambda x: x["leaf"]), " "), value)


def unsupported_leaves(values: DataFrame) -> DataFrame:
    """(binding_id, leaf) of values(binding_id, value, evidence, established array<string>): the numbers and identifiers in the leaves of a JSON value that neither its evidence nor established text holds.

    A number counts as found in any scale it may be written in; an identifier also if a longer one contains it. A value that isn't JSON counts as one leaf. Null evidence and null or
    empty established support nothing; each leaf comes once.
    """
    have = F.concat_ws(" ", "evidence", F.array_join("established", " "))
    rows = values.select("binding_id", leaf_text(F.col("value")).alias("text"), have.alias("have"))
    v = rows.select("binding_id", T.canonical_numbers(F.col("text")).alias("vn"), T.canonical_numbers(F.col("have")).alias("hn"), identifiers(F.col("text")).alias("vi"), identifiers(F.col("have")).alias("hi"))
    loose = F.filter("vi", lambda x: ~F.exists("hi", lambda h: h.contains(x)))
    numbers = F.transform(F.array_except("vn", "hn"), lambda x: x.cast("string"))
    return v.select("binding_id", F.explode(F.array_distinct(F.concat(numbers, loose))).alias("leaf"))


def claims(cells: DataFrame, contexts: DataFrame) -> DataFrame:
    """Sentences of accepted prose with the contexts that their fields cite: (target, field, atom, contexts array<string>)."""
    atoms = cells.select("target", "field", F.posexplode(F.split("value", r"(?<=[.!?])\s+")).alias("n", "atom")).where("trim(atom) <> ''")
    cited = contexts.groupBy("target", "field").agg(F.array_sort(F.collect_set("context")).alias("contexts"))
    return atoms.join(cited, ["target", "field"]).select("target", "field", "n", "atom", "contexts")


def complete(prompts: DataFrame, completer: Callable[[str, int], str], most_tokens: int) -> DataFrame:
    """Answers of a completer to prompts(key, prompt): (key, answer, truncated). The completer is any function that tasks can hold; an error is an answer of null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = []
            for prompt in batch.column("prompt").to_pylist():
                try:
                    answers.append(completer(prompt, most_tokens))
                except Exception:
                    answers.append(None)
            cut_off = [a is not None and len(a.split()) >= most_tokens for a in answers]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(answers, pa.string()), pa.array(cut_off)], ["key", "answer", "truncated"])

    return prompts.select(F.col("key").cast("string").alias("key"), "prompt").mapInArrow(run, "key string, answer string, truncated boolean")
