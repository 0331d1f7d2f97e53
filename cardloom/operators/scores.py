"""Benchmark claims from result tables: the rows that are the target's under the headings above them, and what several sources make of one claim."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T
from cardloom.operators import labels, tables
from cardloom.sources import readers

# The line under a header, a parenthesis at a label's end, what a reader says that found nothing, and what a conflict of sources is called.
RULE = r"^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{2,}:?\s*)*\|?\s*$"
NOTED = r"^(.+?)\s*\(([^()]{1,40})\)\s*$"
UNSAID = "Not specified"
CONFLICT = "score_conflict_between_sources"
NAMED = "structured_table_row_names_target"
PATH = "evaluation.benchmark_scores"

FIELDS = ("benchmark", "score", "metric", "setting", "row_text", "header", "caption", "orientation")


def contexts(lines: DataFrame) -> DataFrame:
    """(doc_id, first_line, caption, scope) of each table of lines(doc_id, at, line): scope joins the headings in force, the caption and the prose right above."""
    begins = labels.around(lines)
    heads = readers.section_lines(lines).select("doc_id", "at", "path")
    both = begins.unionByName(heads, allowMissingColumns=True)
    upto = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("path", F.last("path", ignorenulls=True).over(upto)).where("caption is not null")
    section = F.coalesce(F.array_join("path", " / "), F.lit(""))
    return both.select("doc_id", F.col("at").alias("first_line"), "caption", F.concat_ws(" ", section, "caption", "lead_in").alias("scope"))


def admitted(aliases: Column, stage: Column, scope: Column) -> Column:
    """The aliases that count under a scope: also those without their stage where the scope speaks of that stage only; none where it speaks of the other only."""
    base, post = scope.rlike(labels.BASE_SCOPE), scope.rlike(labels.POST_SCOPE)
    said = F.coalesce(F.when(stage == "base", base & ~post).when(stage == "post", post & ~base), F.lit(False))
    short = F.array_compact(F.transform(aliases, lambda a: labels.bare(a, stage)))
    return F.when(labels.scope_conflict(stage, scope), F.array().cast("array<string>")).when(said, F.array_distinct(F.concat(aliases, short))).otherwise(aliases)


def _is_target(label: Column, c: Callable[[str], Column]) -> Column:
    return F.exists(c("names"), lambda a: labels.names_target(label, a, c("stage"), c("own_readme")))


def _said(read: Callable[[Column], Column], *texts: Column) -> Column:
    """What the first text says that says anything."""
    return F.coalesce(*[F.nullif(read(F.coalesce(t, F.lit(""))), F.lit(UNSAID)) for t in texts], F.lit(UNSAID))


def _split(label: Column) -> tuple[Column, Column]:
    """A label's name and the note in parentheses at its end, empty if it has none."""
    plain = labels.clean(label)
    name = F.regexp_extract(plain, NOTED, 1)
    return F.when(name != "", F.trim(name)).otherwise(plain), F.trim(F.regexp_extract(plain, NOTED, 2))


def _is_benchmark(name: Column) -> Column:
    found = F.filter(F.split(F.lower(name), "[^a-z0-9%@]+"), lambda w: w != "")
    has = lambda words: F.arrays_overlap(found, F.array(*[F.lit(w) for w in words]))
    return (F.size(found) > 0) & (~has(tables.COST_WORDS) | has(tables.BENCHMARK_WORDS))


def target_rows(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """The scores that tables in lines(doc_id, at, line) give for each document's target: (doc_id, block, row, col) and FIELDS.

    targets(doc_id, aliases array<string>, stage base, post or null, own_readme boolean) holds one row for a document; a document without one, or with null aliases, gives no rows. A table whose headings,
    caption and lead-in speak of the other stage only is left out. If a header cell names the target, its column is read down, the columns before the first model telling name, metric and shots; if that yields
    nothing and the header is one of results, rows whose first cell names the target are read across. Repeated lines give repeated rows; scores stay text. Tables meet targets and contexts by document, sorted on both sides: each is as large as the documents, so none is sent to all tasks or gathered.
    """
    told = targets.select("doc_id", "aliases", "stage", F.coalesce("own_readme", F.lit(False)).alias("own_readme")).where("aliases is not null")
    rows = tables.blocks(lines).where((F.col("row") == 0) | ~F.col("line").rlike(RULE)).withColumn("cells", tables.cells(F.col("line")))
    heads = rows.where("row = 0").join(told.hint("merge"), "doc_id").join(contexts(lines).hint("merge"), ["doc_id", "first_line"])
    heads = heads.withColumn("names", admitted(F.col("aliases"), F.col("stage"), F.col("scope"))).where(F.size("names") > 0)
    places = F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda j: (j > 0) & _is_target(F.get("cells", j), F.col))
    heads = heads.withColumn("cols", places).withColumn("lead", F.when(F.size("cols") > 0, labels.leading_columns(F.col("cells"), F.array_min("cols"))))
    heads = heads.select("doc_id", "block", F.col("cells").alias("head"), "caption", "names", "stage", "own_readme", "cols", "lead")
    body = rows.where("row > 0").select("doc_id", "block", "row", "line", "cells").join(heads.hint("merge"), ["doc_id", "block"])

    cell = lambda at: F.coalesce(F.get("cells", at), F.lit(""))
    none = F.array().cast("array<int>")
    is_score = lambda j: F.coalesce(F.get("cells", j).rlike(tables.NUMBER), F.lit(False))

    # the columns that give a score down, and whether any row of the table has one; if none has, those that give one across
    own = F.when(F.size("cols") > 0, cell(F.col("lead.name"))).otherwise("")
    body = body.withColumn("own", own).withColumn("name", _split(F.col("own"))[0])
    body = body.withColumn("down", F.when((F.col("own") != "") & _is_benchmark(F.col("name")), F.filter("cols", is_score)).otherwise(none))
    body = body.withColumn("any_down", F.max(F.size("down") > 0).over(Window.partitionBy("doc_id", "block")))
    mine = ~F.col("any_down") & tables.is_results_header(F.col("head")) & _is_target(F.get("cells", F.lit(0)), F.col)
    across = F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda j: (j > 0) & F.coalesce(F.get("head", j) != "", F.lit(False)) & is_score(j))
    found = body.withColumn("is_down", F.size("down") > 0).withColumn("col", F.explode(F.when(F.col("is_down"), F.col("down")).when(mine, across)))

    found = found.withColumns({"score": F.get("cells", F.col("col")), "own": F.when(F.col("is_down"), F.col("own")).otherwise(F.get("head", F.col("col")))})
    name, note = _split(F.col("own"))
    only = lambda down, x: F.when(F.col("is_down") == down, x).otherwise("")
    found = found.withColumns({"benchmark": name, "note": note, "m": only(True, cell(F.col("lead.metric"))), "shots": only(True, labels.shots(cell(F.col("lead.shots")))), "corner": only(False, F.coalesce(F.get("head", F.lit(0)), F.lit("")))})
    texts = [F.col(x) for x in ("m", "note", "own", "caption", "corner")]
    setting = F.coalesce(F.nullif(F.nullif("shots", F.lit("")), F.lit(UNSAID)), _said(T.setting, *texts))
    orientation = F.when(F.col("is_down"), "benchmark_major").otherwise("model_major")
    return found.select(
        "doc_id", "block", "row", "col", "benchmark", "score", _said(T.metric, *texts).alias("metric"), setting.alias("setting"),
        T.normalized(F.col("line")).alias("row_text"), F.filter("head", lambda h: h != "").alias("header"), "caption", orientation.alias("orientation"),
    )


def claims(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """What rows(target_id, source, block, row, col, FIELDS) of several sources state: one row for each claim that stands or is withheld.

    kinds names the possible sources, the first read first; rows of any other source (or null) are left out. A claim is a benchmark, compared as a label, under a setting. Within one source all its distinct scores stand. Sources that agree in text or
    number give one claim, the first read; sources that don't are all withheld. Gives (target_id, source, block, row, col, FIELDS, sources array<string>, n_values, action accept or withhold, reason); the values of a conflict are its rows' scores, so
    none is gathered in one row. Repeated rows count once.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("source"))
    rows = rows.withColumn("rank", rank).where("rank > 0")
    first = F.min(F.struct("block", "row", "col", "metric", "row_text", "header", "caption", "orientation")).alias("f")
    once = rows.groupBy("target_id", "rank", "source", "benchmark", "score", "setting").agg(first)
    once = once.withColumns({"_name": T.label(F.col("benchmark")), "_set": F.lower("setting"), "_v": T.score_value(F.trim("score")), "_s": F.trim("score")})
    scope = ["target_id", "_name", "_set"]
    flags = [F.max(F.col("source") == k).alias(f"_k{i}") for i, k in enumerate(kinds)]
    told = once.groupBy(*scope, "_s", "_v").agg(*flags)  # one row for each score first, so a claim of many rows is small before it meets
    per = told.groupBy(*scope).agg(
        *[F.max(f"_k{i}").alias(f"_k{i}") for i in range(len(kinds))],
        F.count("*").alias("n_values"),
        (F.count("_v") == F.count("*")).alias("_numbers"),
        (F.min("_v") == F.max("_v")).alias("_equal"),
    )
    sources = F.array_compact(F.array(*[F.when(F.col(f"_k{i}"), k) for i, k in enumerate(kinds)]))
    agree = (F.col("n_values") == 1) | (F.col("_numbers") & F.col("_equal"))
    per = per.select(*scope, "n_values", sources.alias("sources"), F.when(F.size(sources) == 1, "one").when(agree, "agreed").otherwise("conflict").alias("_case"))
    part = F.when(F.col("_case") == "one", F.struct(F.col("_s"), F.lit("").alias("b"), F.lit("").alias("t"), F.lit("").alias("k")))
    part = part.when(F.col("_case") == "conflict", F.struct(F.col("score").alias("_s"), F.col("benchmark").alias("b"), F.col("setting").alias("t"), F.col("source").alias("k")))
    kept = once.join(per.hint("merge"), scope).withColumn("_part", part)
    # order of reading: source, table, line, column
    least = F.min(F.struct("rank", "f.block", "f.row", "f.col", "source", "benchmark", "score", "setting", "f")).alias("_m")
    kept = kept.groupBy(*scope, "_part", "_case", "n_values", "sources").agg(least)
    held = F.col("_case") == "conflict"
    m = lambda x: F.col(f"_m.{x}").alias(x)
    deep = {"metric", "row_text", "header", "caption", "orientation"}
    return kept.select(
        "target_id", m("source"), m("block"), m("row"), m("col"),
        *[F.col(f"_m.f.{x}").alias(x) if x in deep else m(x) for x in FIELDS],
        F.when(held, F.array(F.col("_m.source"))).otherwise(F.col("sources")).alias("sources"), "n_values",
        F.when(held, "withhold").otherwise("accept").alias("action"), F.when(held, CONFLICT).otherwise(NAMED).alias("reason"),
    )


def with_spans(found: DataFrame, sources: DataFrame) -> DataFrame:
    """claims() with path, start and end: where the row's text first stands in the normalized text of sources(target_id, source, text); a claim whose row isn't there goes.

    A source's claims are gathered beside its text, which holds them all, so each text travels once; offsets count from 0, the end is exclusive.
    """
    claim = F.struct(*[c for c in found.columns if c not in ("target_id", "source")])
    per = found.groupBy("target_id", "source").agg(F.collect_list(claim).alias("_c"))
    texts = sources.select("target_id", "source", T.normalized(F.col("text")).alias("_t"))
    rows = per.join(texts.hint("merge"), ["target_id", "source"]).select("target_id", "source", F.inline(F.transform("_c", lambda c: F.struct(c.alias("c"), (F.call_function("locate", c["row_text"], F.col("_t")) - 1).cast("long").alias("start")))))
    rows = rows.where("start >= 0").select("target_id", "source", "c.*", "start")
    return rows.withColumns({"end": F.col("start") + F.char_length("row_text"), "path": F.lit(PATH)})
