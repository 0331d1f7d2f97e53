"""The frame: which entities a target's sources name, and which of them a statement is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.operators.occurrences import with_names

MODELS = ("base", "family", "sibling", "comparison")
FAR = 1_000_000

# Phrases that speak of the model at hand, and of members of the other stage.
DEICTIC = (
    r"(?i)\b(our|this|the present|the proposed|the resulting|the final)\s+(model|models|checkpoint|checkpoints|release|system)\b"
    r"|\bwe (introduce|present|propose|release|train|pretrain|post-train|fine-?tune|build)\b|\bours\b"
)
POST = r"(?:instruction[- ]tuned|instruct|chat|aligned|post-?trained|fine-?tuned|reasoning)"
BASE = r"(?:pre-?trained|base|foundation)"
NOUN = r"(?:text[- ]only\s+)?(?:models?|versions?|variants?|checkpoints?)"
COORDINATION = r"(?:\s*[,/&+]\s*|\s+(?:and|or|as well as)\s+)"
# Clauses that credit the technology a model came from.
CREDIT = (
    r"(?i)\b(?:built|created|developed|derived|made|trained)\s+(?:from|with|using|on|upon)\s+(?:the\s+)?(?:same\s+)?"
    r"(?:research|technology|techniques?|methods?|recipe|architecture|codebase|infrastructure)\b"
    r"|\bthe\s+same\s+(?:research|technology|techniques?|methods?|recipe|architecture|codebase)\b"
    r"|\b(?:based\s+on|inspired\s+by)\s+the\s+(?:same\s+)?(?:research|technology|approach|recipe|architecture|codebase)\b"
)


def merge_nodes(nodes: DataFrame) -> DataFrame:
    """nodes(target, id, type, name, aliases, seq): nodes of one id are one, with the first type and name and all aliases."""
    first = F.min(F.struct("seq", "type", "name"))
    aliases = F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases"))))
    return nodes.groupBy("target", "id").agg(first.alias("f"), aliases.alias("aliases")).select("target", "id", "f.type", "f.name", "aliases")


def base_nodes(tags: DataFrame) -> DataFrame:
    """tags(target, tag "kind:model" or "model"): one row for each base model, its kind by the first qualified tag, else base."""
    kind, model = F.regexp_extract("tag", r"^(?:([a-z]+):)?(.+)$", 1), F.regexp_extract("tag", r"^(?:([a-z]+):)?(.+)$", 2)
    rows = tags.select("target", model.alias("model"), kind.alias("kind"))
    return rows.groupBy("target", "model").agg(F.coalesce(F.min(F.when(F.col("kind") != "", F.col("kind"))), F.lit("base")).alias("kind"))


def mentions(records: DataFrame, nodes: DataFrame) -> DataFrame:
    """(record_id, id, type, at): where each node of the record's target is first named in its quote, without case; from 0.

    A name inside a longer name that is also there does not count. Records meet only the names of their own target, all in one pass over the quote.
    """
    names = nodes.select("target", "id", "type", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("alias"))
    found = with_names(records.select("target", "record_id", F.lower("quote").alias("text")), names.select("target", F.lower(F.trim("alias")).alias("name"), "id", "type"))
    return found.select("record_id", F.explode("hits").alias("h")).groupBy("record_id", "h.id", "h.type").agg(F.min("h.at").alias("at"))


def other_stage(stage: Column, quote: Column) -> Column:
    """True if the sentence is about the other member of the pair, and not about both."""
    said = lambda adjective: quote.rlike(rf"(?i)\b{adjective}\s+{NOUN}\b")
    return F.coalesce(F.when(stage == "base", said(POST)).when(stage == "post", said(BASE)) & ~both_stages(quote), F.lit(False))


def both_stages(quote: Column) -> Column:
    """True if the sentence names the two members of the pair together, each with or without a noun."""
    joined = lambda a, b: rf"\b{a}(?:\s+{NOUN})?{COORDINATION}{b}\b"
    return quote.rlike(rf"(?i){joined(BASE, POST)}|{joined(POST, BASE)}")


def resolve(records: DataFrame, nodes: DataFrame) -> DataFrame:
    """records(target, record_id, quote, referent, default_referent, stage) with the referent each statement turns out to be about.

    Adds resolved, comparison, roster, has_family, other_stage and names_target. In order: a sentence that speaks of "this model" before it names another is about
    the document's default; one that names the target and two others enumerates the family; one that names the target and one other is a comparison if the other comes first; one that names just one other is about that,
    unless it only credits it.
    """
    m = mentions(records, nodes)
    is_other = (F.col("type") != "target") & F.col("type").isin(*MODELS)
    per = m.groupBy("record_id").agg(
        F.min(F.when(F.col("type") == "target", F.col("at"))).alias("target_at"),
        F.min(F.when(is_other, F.struct("at", "id"))).alias("other"),
        F.count_if(is_other).alias("others"),
        F.min(F.when(F.col("type") == "family", F.col("id"))).alias("family"),
    )
    r = records.join(per, "record_id", "left").withColumn("others", F.coalesce("others", F.lit(0)))
    other_at = F.coalesce("other.at", F.lit(FAR))
    deictic_at = F.when(F.col("quote").rlike(DEICTIC), F.regexp_instr("quote", F.lit(DEICTIC)) - 1)
    named = F.col("target_at").isNotNull()
    deictic = deictic_at.isNotNull() & ~named & (deictic_at < other_at)
    roster = named & (F.col("others") >= 2)
    credit = F.when(F.col("quote").rlike(CREDIT), F.regexp_instr("quote", F.lit(CREDIT)) - 1)
    sole = ~named & (F.col("others") == 1) & deictic_at.isNull() & F.coalesce(other_at <= credit, F.lit(True))
    resolved = F.when(deictic, F.col("default_referent")).when(roster, F.coalesce("family", "referent")).when(sole, F.col("other.id")).otherwise(F.col("referent"))
    return r.select(
        *records.columns,
        resolved.alias("resolved"),
        (roster | (named & (F.col("others") == 1) & (F.col("target_at") > other_at))).alias("comparison"),
        roster.alias("roster"),
        F.col("family").isNotNull().alias("has_family"),
        (~named & other_stage(F.col("stage"), F.col("quote"))).alias("other_stage"),
        named.alias("names_target"),
    )


def splice_probes(values: DataFrame, lines: DataFrame) -> DataFrame:
    """values(field, token) whose token stands only on lines(line_id, owner, text) that other entities own: (field, token, others, strength)."""
    words = lines.select("owner", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\d]+)"), 1))).alias("token"))
    seen = words.groupBy("token").agg(F.bool_or(F.col("owner") == "target").alias("own"), F.count_if(F.col("owner") != "target").alias("others"))
    strength = F.when(F.col("others") >= 3, "strong").when(F.col("others") == 2, "moderate").otherwise("weak")
    return values.join(seen, "token").where("not own and others > 0").select("field", "token", "others", strength.alias("strength"))
