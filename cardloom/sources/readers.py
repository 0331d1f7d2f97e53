"""Readers of the inputs that evidence comes from: target lists, usage logs, evaluation records, cards and frozen files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

USAGE = "input_tokens long, output_tokens long, cost double, provider string"
EVALUATION = (
    "evaluation_results array<struct<evaluation_name: string, metric_config: struct<metric_name: string, metric_id: string>, "
    "score_details: struct<score: double>, source_data: struct<hf_repo: string>, evaluation_result_id: string>>"
)


def parse_target(target: Column) -> Column:
    """struct(model_id, revision) of "model@revision", split at the last @; an empty half is an error."""
    pattern = "^(.+)@([^@]+)$"
    bad = F.raise_error(F.concat(F.lit("a target is model@revision: "), target)).cast("string")
    half = lambda n: F.when(target.rlike(pattern), F.regexp_extract(target, pattern, n)).otherwise(bad)
    return F.struct(half(1).alias("model_id"), half(2).alias("revision"))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(pos, target): the trimmed lines of a list file, blank and # lines out, the first of equal ones kept."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    lines = lines.select("pos", F.trim("line").alias("target")).where("target <> '' and not startswith(target, '#')")
    return lines.groupBy("target").agg(F.min("pos").alias("pos")).select("pos", "target")


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines usage log; blank and broken lines are dropped, the run is the file's folder."""
    rows = spark.read.schema(USAGE).option("mode", "DROPMALFORMED").json(path)
    return rows.withColumn("run", F.element_at(F.split(F.input_file_name(), "/"), -2))


def read_evaluations(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation records (.../benchmark/owner/model/file.json), a row for each result; unreadable files give none."""
    files = spark.read.schema(EVALUATION).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).json(path)
    part = F.split(F.input_file_name(), "/")
    rows = files.select(F.element_at(part, -4).alias("benchmark"), F.concat_ws("/", F.element_at(part, -3), F.element_at(part, -2)).alias("model_id"), F.explode("evaluation_results").alias("r"))
    return rows.select("benchmark", "model_id", "r.evaluation_name", "r.metric_config.metric_name", "r.metric_config.metric_id", "r.score_details.score", "r.source_data.hf_repo", "r.evaluation_result_id")


def freeze(spark: SparkSession, path: str) -> DataFrame:
    """(name, uri, sha256, size_bytes, content, valid): text files as they are, strict UTF-8 only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("uri"), F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("size_bytes"), F.when(valid, F.col("content").cast("string")).alias("content"), valid.alias("valid"),
    )


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """(target, section, field, value): JSON cards of sections and fields, one row for each field; values as JSON text, strings bare."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("target"), F.try_parse_json("value").alias("card"))
    return spark.sql(
        "SELECT target, s.key AS section, f.key AS field, CASE WHEN schema_of_variant(f.value) = 'STRING' THEN variant_get(f.value, '$', 'string') ELSE to_json(f.value) END AS value "
        "FROM {cards}, LATERAL variant_explode(card) s, LATERAL variant_explode(s.value) f WHERE schema_of_variant(s.value) LIKE 'OBJECT%'",
        cards=whole,
    )


def front_matter(text: Column) -> Column:
    """The top-level scalars of the first --- block as a map; list items and nested keys are left out, a text without a block gives an empty map."""
    block = F.regexp_extract(text, r"^---\n((?s:.*?))\n---", 1)
    pairs = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:\s*\S"))
    entries = F.transform(pairs, lambda x: F.struct(F.regexp_extract(x, r"^([\w-]+):", 1).alias("k"), F.regexp_replace(F.trim(F.regexp_extract(x, r"^[\w-]+:\s*(.*)$", 1)), "^[\"']|[\"']$", "").alias("v")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda y: y["k"]), e["k"]) == i + 1)
    return F.map_from_entries(first)


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, at, level, title, path): the headings of Markdown documents with the titles above each, outermost first."""
    return section_lines(docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")))


def section_lines(lines: DataFrame) -> DataFrame:
    """As sections, of lines(doc_id, at, line)."""
    heads = lines.where(F.col("line").rlike(r"^#{1,6}\s+\S")).select("doc_id", "at", F.length(F.regexp_extract("line", "^(#+)", 1)).alias("level"), F.trim(F.regexp_extract("line", r"^#+\s+(.*)$", 1)).alias("title"))
    upto = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    for k in range(1, 7):
        heads = heads.withColumn(f"_h{k}", F.last(F.when(F.col("level") == k, F.struct("at", "title")), ignorenulls=True).over(upto))
    open_ = []
    for k in range(1, 7):  # a heading is above a line if no heading of its level or an outer one came between
        later = [F.coalesce(F.col(f"_h{j}.at"), F.lit(-1)) <= F.col(f"_h{k}.at") for j in range(1, k)]
        above = F.col("level") >= k
        for x in later:
            above = above & x
        open_.append(F.when(above, F.col(f"_h{k}.title")))
    return heads.select("doc_id", "at", "level", "title", F.array_compact(F.array(*open_)).alias("path"))
