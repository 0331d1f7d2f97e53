"""Labels of models in tables: what they are made of, whether they name the target, and what the lines around a table say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T

# Words that name a training stage, and the stage they name.
STAGE_WORDS = {
    "pt": "base", "base": "base", "pretrain": "base", "pretrained": "base",
    "it": "instruct", "instruct": "instruct", "instruction": "instruct", "instructed": "instruct", "tuned": "instruct",
    "chat": "chat", "aligned": "aligned", "sft": "sft", "dpo": "dpo", "rlhf": "rlhf", "rlvr": "rlvr",
    "think": "thinking", "thinking": "thinking", "reasoning": "reasoning",
}
PRECISION_WORDS = ("bf16", "fp16", "f16", "fp32", "float16", "bfloat16", "ours")
DECORATIONS = ("ours", "this work", "this model")
SIZE = r"^\d+(?:\.\d+)?[bmk]$|^\d+x\d+(?:\.\d+)?[bm]$"
VERSION = r"^v?\d+(?:\.\d+)*$"
BARE_BASE = r"(?i)[-_ ]+(?:base|pt)$"
BARE_POST = r"(?i)[-_ ]+(?:instruct|it|chat|sft|dpo|rlhf|rlvr)$"
BASE_SCOPE = r"(?i)\b(base model|base models|pre-?training|pretrained model|foundation model)\b"
POST_SCOPE = r"(?i)\b(post-?training|chat model|chat models|instruct(?:ion)?[- ]tuned|instruction following|aligned model|thinking mode|non-?thinking|reasoning model)\b"
CAPTION = r"(?i)^\s*(?:\*\*)?\s*Table\s*\d*[.:]?\s*(.+?)\s*(?:\*\*)?\s*$"
NAME_COLUMN = r"^(?:benchmark|benchmarks|task|tasks|dataset|datasets|eval|evals|evaluation)\b"
METRIC_COLUMN = r"^metric"
SHOTS_COLUMN = r"^(?:n\s+)?shots?\b"

# Parts of repository names that are no part of the family's name, and those that mark a derivative.
NAME_SIZE = r"(?i)^\d+(?:\.\d+)?[bm]$"
NAME_MIXTURE = r"(?i)^\d+x\d+[bm]$"
NAME_DATE = r"^(?:\d{4}|\d{6}|\d{8})$"
NAME_STAGES = (
    "instruct", "chat", "it", "sft", "dpo", "rl", "rlhf", "rlvr", "base", "pt", "hf",
    "preview", "think", "thinking", "reasoning", "gguf", "awq", "gptq", "fp8",
    "int4", "int8", "bnb", "4bit", "8bit", "instruct-v2", "v0.1", "v0.2",
)
DERIVATIVES = (
    "instruct", "chat", "it", "sft", "dpo", "rl", "rlhf", "rlvr", "think", "thinking", "reasoning",
    "tulu", "distill", "merge", "gguf", "awq", "gptq", "fp8", "int4", "int8",
)


def clean(label: Column) -> Column:
    """A cell's own words: Markdown links, inline or by reference, by their text."""
    plain = F.regexp_replace(F.coalesce(label, F.lit("")), r"\[([^\]]+)\](?:\([^)]*\)|\[[^\]]*\])?", "$1")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def parts(label: Column) -> Column:
    """struct(words, sizes, stages), sorted and distinct: precision words are left out, dots stay inside a part."""
    stage = F.create_map(*[F.lit(x) for kv in STAGE_WORDS.items() for x in kv])
    tidy = lambda c: F.array_sort(F.array_distinct(c))

    def told(found: Column) -> Column:
        sizes = F.filter(found, lambda x: x.rlike(SIZE))
        stages = F.filter(found, lambda x: ~x.rlike(SIZE) & x.isin(*STAGE_WORDS))
        words = F.filter(found, lambda x: ~x.rlike(SIZE) & ~x.isin(*STAGE_WORDS))
        return F.struct(tidy(words).alias("words"), tidy(sizes).alias("sizes"), tidy(F.transform(stages, lambda x: F.element_at(stage, x))).alias("stages"))

    found = F.transform(F.split(F.lower(F.coalesce(label, F.lit(""))), r"[^a-z0-9.]+"), lambda x: F.btrim(x, F.lit(".")))
    return T.let(F.filter(found, lambda x: (x != "") & ~x.isin(*PRECISION_WORDS)), told)


def names_target(label: Column, alias: Column, stage: Column, own_readme: Column) -> Column:
    """True if a label is the target's alias: equal once normalized, decorated, or made of the same parts; never by containment.

    A stage that the label states and the alias doesn't counts only where it is the target's own; a version may be missing only in the target's own readme.
    """
    def equal(a: Column, b: Column) -> Column:
        return (b != "") & ((a == b) | F.exists(F.array(*[F.lit(x) for x in DECORATIONS]), lambda x: a == F.concat(b, F.lit(" "), x)))

    def made(p: Column, q: Column) -> Column:
        coarse = F.array_distinct(F.transform(p["stages"], lambda x: F.when(x == "base", "base").otherwise("post")))
        staged = F.when((F.size(q["stages"]) > 0) & (F.size(p["stages"]) > 0), q["stages"] == p["stages"]).when(F.size(q["stages"]) > 0, False).when(F.size(p["stages"]) > 0, F.coalesce(coarse == F.array(stage), F.lit(False))).otherwise(True)
        missing = F.array_except(q["words"], p["words"])
        short = own_readme & (F.size(missing) > 0) & (F.size(F.array_except(p["words"], q["words"])) == 0) & F.forall(missing, lambda x: x.rlike(VERSION))
        return (F.size(p["words"]) > 0) & (F.size(q["words"]) > 0) & (F.size(coarse) <= 1) & (p["sizes"] == q["sizes"]) & staged & ((p["words"] == q["words"]) | short)

    def told(n: Column) -> Column:
        parted = T.let(parts(label), lambda p: T.let(parts(alias), lambda q: made(p, q)))
        return (n["a"] != "") & (equal(n["a"], n["b"]) | ((n["b"] != "") & parted))

    return F.coalesce(T.let(F.struct(T.label(label).alias("a"), T.label(alias).alias("b")), told), F.lit(False))


def bare(alias: Column, stage: Column) -> Column:
    """An alias without the stage at its end, for tables whose heading names that stage; null if it has none."""
    short = F.when(stage == "base", F.regexp_replace(alias, BARE_BASE, "")).otherwise(F.regexp_replace(alias, BARE_POST, ""))
    return F.when((short != "") & (short != alias), short)


def scope_conflict(stage: Column, context: Column) -> Column:
    """True if headings and captions speak of the other stage only."""
    base, post = context.rlike(BASE_SCOPE), context.rlike(POST_SCOPE)
    return F.coalesce(F.when(stage == "base", post & ~base).when(stage.isNotNull(), base & ~post), F.lit(False))


def shots(cell: Column) -> Column:
    """The setting that a column of shots states: 5 as 5-shot, 3-5 as 3-5 shot, else what the text says."""
    text = F.trim(F.coalesce(cell, F.lit("")))
    return (
        F.when(text == "", "Not specified")
        .when(text.rlike(r"^\d{1,2}$"), F.concat(text, F.lit("-shot")))
        .when(text.rlike(r"^\d{1,2}\s*-\s*\d{1,2}$"), F.concat(F.regexp_replace(text, r"\s*-\s*", "-"), F.lit(" shot")))
        .otherwise(T.setting(text))
    )


def leading_columns(header: Column, first_model: Column) -> Column:
    """struct(name, metric, shots): places of the columns before the first model that hold these.

    Place 0 stands for the name until a later column has a name's heading, so of two such columns at 0 and 1 the second is it; name is 0 and the others null where none does. A column that the name takes is no other.
    """
    norm = F.transform(F.slice(header, 1, F.greatest(first_model, F.lit(0))), T.label)
    start = F.struct(F.lit(0).alias("name"), F.lit(None).cast("int").alias("metric"), F.lit(None).cast("int").alias("shots"))

    def take(found: Column, cell: Column) -> Column:
        at, heading = cell["at"], cell["heading"]
        named = (found["name"] == 0) & heading.rlike(NAME_COLUMN)
        metric = ~named & found["metric"].isNull() & heading.rlike(METRIC_COLUMN)
        shots = ~named & ~metric & found["shots"].isNull() & heading.rlike(SHOTS_COLUMN)
        return F.struct(F.when(named, at).otherwise(found["name"]).alias("name"), F.when(metric, at).otherwise(found["metric"]).alias("metric"), F.when(shots, at).otherwise(found["shots"]).alias("shots"))

    return F.aggregate(F.transform(norm, lambda x, i: F.struct(i.alias("at"), x.alias("heading"))), start, take)


def around(lines: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, at, caption, lead_in) of each line of lines(doc_id, at, line) that begins a table.

    caption: the nearest of three lines above that isn't blank, if it reads Table N. lead_in: up to `most` lines of prose right above, joined, blanks between it and the table aside; headings and tables end it.
    Each document's lines are looked at through windows of the lines before, so no document is gathered.
    """
    w = Window.partitionBy("doc_id").orderBy("at")
    line = F.trim(F.col("line"))
    rows = lines.select("doc_id", "at", line.alias("line"), line.startswith("|").alias("cells"))
    rows = rows.withColumn("begins", F.col("cells") & ~F.coalesce(F.lag("cells").over(w), F.lit(False)))
    above = [F.lag("line", k).over(w) for k in range(1, 4)]
    near = F.coalesce(*[F.when(x != "", x) for x in above])
    rows = rows.withColumn("caption", F.coalesce(F.regexp_extract(near, CAPTION, 1), F.lit("")))
    # prose lines are numbered in runs that blanks, headings and tables end; a table takes the last run if only blanks lie between
    prose = (F.col("line") != "") & ~F.col("cells") & ~F.col("line").rlike(r"^#{1,6}\s")
    rows = rows.withColumns({"prose": prose, "stop": F.col("cells") | F.col("line").rlike(r"^#{1,6}\s")})
    rows = rows.withColumn("run", F.sum((~F.col("prose")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy("doc_id", "run").orderBy("at")
    upto = F.array_join(F.array_compact(F.array(*[F.when(F.lag("prose", k).over(in_run), F.lag("line", k).over(in_run)) for k in range(most - 1, 0, -1)], F.when(F.col("prose"), F.col("line")))), " ")
    rows = rows.withColumn("text", F.when(F.col("prose"), upto))
    last = F.last(F.when(F.col("prose") | F.col("stop"), F.struct(F.col("stop").alias("stop"), F.col("text").alias("text"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", last)
    return rows.where("begins").select("doc_id", "at", "caption", F.coalesce(F.when(~F.col("before.stop"), F.col("before.text")), F.lit("")).alias("lead_in"))


def _tokens(model_id: Column) -> Column:
    return F.filter(F.split(F.substring_index(model_id, "/", -1), "[-_ ]+"), lambda x: x != "")


def _family(tokens: Column, model_id: Column) -> Column:
    kept = F.filter(tokens, lambda x: ~x.rlike(NAME_SIZE) & ~x.rlike(NAME_DATE) & ~x.rlike(NAME_MIXTURE) & ~F.lower(x).isin(*NAME_STAGES))
    return T.let(kept, lambda k: F.when(F.size(k) > 0, F.array_join(k, " ")).otherwise(F.substring_index(model_id, "/", -1)))


def family(model_id: Column) -> Column:
    """A repository's family: its name without size, date, stage and packaging."""
    return _family(_tokens(model_id), model_id)


def is_derivative(model_id: Column) -> Column:
    return F.exists(_tokens(model_id), lambda x: F.lower(x).isin(*DERIVATIVES))


def aliases(model_id: Column) -> Column:
    """How a target is written: its id, its name with blanks, and for each size the family with size and stages, joined by blanks, by hyphens and half and half."""
    def spelled(fam: Column, hyphened: Column, stages: Column, size: Column) -> Column:
        plain, joined = (F.array_join(F.concat(F.array(size), stages), x) for x in (" ", "-"))
        return F.array(F.concat(fam, F.lit(" "), plain), F.concat(fam, F.lit("-"), joined), F.concat(hyphened, F.lit("-"), joined), F.concat(hyphened, F.lit(" "), plain))

    def told(tokens: Column) -> Column:
        sizes = F.filter(tokens, lambda x: x.rlike(NAME_SIZE) | x.rlike(NAME_MIXTURE))
        parts = F.struct(_family(tokens, model_id).alias("fam"), F.filter(tokens, lambda x: F.lower(x).isin(*NAME_STAGES)).alias("stages"))
        hyphened = lambda p: F.replace(p["fam"], F.lit(" "), F.lit("-"))
        return T.let(parts, lambda p: F.flatten(F.transform(sizes, lambda size: spelled(p["fam"], hyphened(p), p["stages"], size))))

    own = F.array(model_id, F.replace(F.substring_index(model_id, "/", -1), F.lit("-"), F.lit(" ")))
    return F.array_distinct(F.concat(own, T.let(_tokens(model_id), told)))
