"""Markdown tables in documents: islands of pipe lines, cells, and the scores of one model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T

# Header words of results tables and of cost tables.
BENCHMARK_WORDS = (
    "average", "avg", "score", "scores", "accuracy", "acc", "pass", "em", "f1", "win", "elo", "mmlu", "mmlupro", "gsm8k", "gsm", "math", "arc",
    "hellaswag", "hswag", "winogrande", "winog", "truthfulqa", "humaneval", "mbpp", "bbh", "drop", "nq", "triviaqa", "agieval", "gpqa", "ifeval",
    "alpacaeval", "ae2", "arenahard", "mtbench", "mt", "bench", "safety", "popqa", "squad", "boolq", "piqa", "siqa", "openbookqa", "obqa", "csqa",
    "commonsenseqa", "coqa", "mgsm", "livecodebench", "swe", "aime", "codeforces", "livebench", "mmmu", "mathvista", "docvqa", "chartqa", "ai2d",
    "textvqa", "vqav2", "lambada", "wikitext", "ppl", "perplexity", "rouge", "bleu", "chrf", "wer", "cer", "ndcg", "mrr", "recall", "precision", "auc",
    "hits", "toxigen", "bias", "xstest", "hallucination", "helm", "leaderboard", "benchmark", "benchmarks", "task", "tasks", "eval", "evaluation",
    "results", "%", "@",
)
COST_WORDS = (
    "flops", "flop", "mwh", "kwh", "tco2eq", "tco2", "co2", "carbon", "power", "energy", "pue", "hours", "gpu", "gpus", "tokens", "params", "parameters",
    "price", "cost", "latency", "throughput", "memory", "vram", "tps", "steps", "batch", "lr", "epochs", "checkpoints", "size", "context", "length",
    "date", "release", "license", "downloads", "layers", "layer", "heads", "head", "dim", "dims", "dimension", "hidden", "vocab", "vocabulary", "experts",
    "expert", "kv", "rope", "seq", "window", "quantization", "precision", "dtype", "activated", "embedding", "embeddings", "ffn", "mlp", "groups",
    "tokenizer", "optimizer", "warmup", "schedule", "stage", "stages", "budget",
)
NUMBER = r"^[<>~≈]?\s*-?\d+(?:[.,]\d+)?\s*%?(?:\s*[±+/-]\s*\d+(?:\.\d+)?)?$"


def text_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))


def blocks(lines: DataFrame) -> DataFrame:
    """The islands of lines(doc_id, at, line), a row for each line: (doc_id, block, first_line, row, line). No island is gathered in one row."""
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("at"))
    pipes = lines.where(F.col("doc_id").isNotNull() & F.col("line").rlike(r"^\s*\|")).withColumn("run", F.col("at") - rank)
    run = Window.partitionBy("doc_id", "run")
    runs = pipes.withColumns({"first_line": F.min("at").over(run), "n": F.count("*").over(run)}).where("n >= 2")
    block = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("first_line", "run")) - 1
    return runs.select("doc_id", block.alias("block"), "first_line", (F.col("at") - F.col("first_line")).alias("row"), "line")


def islands(docs: DataFrame) -> DataFrame:
    """Blocks of two or more consecutive lines that begin with a pipe: (doc_id, block, first_line, lines array<string>)."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct("row", "line"))), lambda x: x["line"])
    return blocks(text_lines(docs)).groupBy("doc_id", "block", "first_line").agg(lines.alias("lines"))


def cells(line: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(inner, r"\|"), lambda c: F.trim(F.regexp_replace(c, "[*_`]+", "")))


def is_results_header(header: Column) -> Column:
    """A header with a word of a benchmark; if it also has a word of cost, one more telling than task or results."""
    found = F.split(F.lower(F.array_join(header, " ")), "[^a-z0-9%@]+")
    words = lambda names: F.array(*[F.lit(x) for x in names])
    telling = words([x for x in BENCHMARK_WORDS if x not in ("task", "tasks", "results")])
    return F.arrays_overlap(found, words(BENCHMARK_WORDS)) & (~F.arrays_overlap(found, words(COST_WORDS)) | F.arrays_overlap(found, telling))


def _scores(found: DataFrame, orientation: str) -> DataFrame:
    name = F.regexp_extract("benchmark", r"^(.+?)\s*\(([^()]{1,40})\)\s*$", 1)
    note = F.regexp_extract("benchmark", r"^(.+?)\s*\(([^()]{1,40})\)\s*$", 2)
    return found.where(F.col("score").rlike(NUMBER) & (F.col("benchmark") != "")).select(
        "doc_id", "block",
        F.when(name != "", name).otherwise(F.col("benchmark")).alias("benchmark"),
        "score",
        T.metric(F.col("benchmark")).alias("metric"),
        F.when(note != "", T.setting(note)).otherwise("Not specified").alias("setting"),
        F.lit(orientation).alias("orientation"),
    )


def score_rows(docs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Scores that tables give for the models of aliases(doc_id, alias): (doc_id, block, benchmark, score, metric, setting, orientation).

    Tables with a column of its own for the model are read down that column; else, under a results header, the rows whose first cell names it are read across. Labels match
    by equality after normalizing, never by containment. Scores stay text; only numeric cells count.
    """
    return score_lines(text_lines(docs), aliases)


def score_lines(lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """As score_rows, of lines(doc_id, at, line)."""
    rows = blocks(lines).select("doc_id", "block", "row", "line").withColumn("cells", cells(F.col("line"))).where(~F.col("line").rlike(r"^[\s|:-]+$"))
    header = rows.where("row = 0").select("doc_id", "block", F.col("cells").alias("header"))
    named = aliases.select("doc_id", T.label(F.col("alias")).alias("name")).distinct()
    across = header.select("doc_id", "block", "header", F.posexplode("header").alias("col", "head")).withColumn("name", T.label(F.col("head")))
    columns = across.where("col > 0").join(named, ["doc_id", "name"]).select("doc_id", "block", "col").distinct()
    body = rows.where("row > 0").select("doc_id", "block", "row", "cells")
    down = body.join(columns, ["doc_id", "block"]).select("doc_id", "block", F.get("cells", F.lit(0)).alias("benchmark"), F.get("cells", F.col("col")).alias("score"))
    cost = F.arrays_overlap(F.split(F.lower("benchmark"), "[^a-z0-9%@]+"), F.array(*[F.lit(x) for x in COST_WORDS]))
    known = F.arrays_overlap(F.split(F.lower("benchmark"), "[^a-z0-9%@]+"), F.array(*[F.lit(x) for x in BENCHMARK_WORDS]))
    by_column = _scores(down.where(~cost | known), "column")
    rest = header.join(columns.select("doc_id", "block").distinct(), ["doc_id", "block"], "left_anti").where(is_results_header(F.col("header")))
    mine = body.withColumn("name", T.label(F.get("cells", F.lit(0)))).join(named, ["doc_id", "name"]).join(rest, ["doc_id", "block"])
    pairs = mine.select("doc_id", "block", F.explode(F.slice(F.arrays_zip(F.col("header").alias("h"), F.col("cells").alias("c")), 2, F.greatest(F.size("header"), F.size("cells")))).alias("z"))
    by_row = _scores(pairs.select("doc_id", "block", F.col("z.h").alias("benchmark"), F.col("z.c").alias("score")), "row")
    return by_column.unionByName(by_row)


def _nth(text: Column, part: Column, n: Column, start: Column, end: Column) -> Column:
    """Where the n-th occurrence (from 0) of part begins in text from start on and ends by end, each looked for behind the one before; -1 if there are fewer."""
    size = F.char_length(part)

    def next_one(at: Column, _: Column) -> Column:
        found = F.call_function("locate", part, text, at + 1) - 1
        return F.when((at < 0) | (found < 0) | (found + size > end), F.lit(-1)).otherwise(found + size)

    after = F.aggregate(F.sequence(F.lit(0), n), start.cast("int"), next_one)
    return F.when(after < 0, F.lit(-1)).otherwise(after - size)


def row_spans(requests: DataFrame, sources: DataFrame) -> DataFrame:
    """(request_id, start, end, fault): where a row stands in a block of a source, in normalized text.

    requests(request_id, source_id, block, row, nth_block, nth_row): the nth_row-th occurrence of the row inside the nth_block-th occurrence of the block, both from 0, occurrences not overlapping.
    Faults: negative_occurrence, empty_text (block or row is blank), source_absent, block_absent, row_absent; then start and end are null. Requests meet sources(source_id, text) by id, and offsets are found by
    stepping from one occurrence to the next, so no document is taken apart.
    """
    texts = sources.select("source_id", T.normalized(F.coalesce("text", F.lit(""))).alias("_text"))
    r = requests.select("request_id", "source_id", T.normalized(F.coalesce("block", F.lit(""))).alias("block"), T.normalized(F.coalesce("row", F.lit(""))).alias("row"), F.col("nth_block").cast("int").alias("nth_block"), F.col("nth_row").cast("int").alias("nth_row"))
    early = F.when((F.col("nth_block") < 0) | (F.col("nth_row") < 0), "negative_occurrence").when((F.col("block") == "") | (F.col("row") == ""), "empty_text")
    rows = r.withColumn("early", early).join(texts.hint("merge"), "source_id", "left")
    early = F.coalesce("early", F.when(F.col("_text").isNull(), "source_absent"))
    block = F.when(early.isNull(), _nth(F.col("_text"), F.col("block"), F.col("nth_block"), F.lit(0), F.char_length("_text")))
    rows = rows.withColumn("early", early).withColumn("at_block", block)
    start = F.when(F.col("at_block") >= 0, _nth(F.col("_text"), F.col("row"), F.col("nth_row"), F.col("at_block"), F.col("at_block") + F.char_length("block")))
    rows = rows.withColumn("start", start)
    fault = F.coalesce("early", F.when(F.col("at_block") < 0, "block_absent"), F.when(F.col("start") < 0, "row_absent"))
    found = fault.isNull()
    return rows.select("request_id", F.when(found, F.col("start")).cast("long").alias("start"), F.when(found, F.col("start") + F.char_length("row")).cast("long").alias("end"), fault.alias("fault"))
