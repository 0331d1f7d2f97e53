"""Queries on benchmark claims: parts as models, each with a readme and a paper that hold tables, beside the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import scores
from cardloom.plans.catalogue import dealt, query

KINDS = ("readme", "paper", "html")

# Six kinds of models, by key: tables under a heading of the own or of the other stage, models as rows, sources that agree or don't, one source with several tables. {0} the name, {1} its size, {2} one more.
_BY_COLUMN = ("| Category | Benchmark | Metric | # Shots | {0} | Other 7B |", "|---|:---:|---|---|---|---|", "| General | [MMLU][m] (acc) | EM | 5 | {1} | 1 |", "| | ARC | | | {2} | 2 |", "| Cost | GPU hours | | | 3 | 4 |", "| Math | | EM | 4 | 5 | 6 |")
_README = {
    0: ("# Results", "## Base Model", "", "Table 1. Accuracy, 4-shot", "", *_BY_COLUMN),
    1: ("# Results", "## Base Model", "", "Table 1. Accuracy, 4-shot", "", *_BY_COLUMN),
    2: ("## Base Model", "text", "## Scores", "We report below.", "", "| Model (em) | MMLU (5-shot) | GSM8K | Note |", "|---|---|---|---|", "| **{0} (ours)** | {1} | {2} % | n/a |", "| Other 7B | 1 | 2 | 3 |", "| {0} | {1} | n/a | n/a |"),
    3: ("| Task | {0} |", "|---|---|", "| MMLU | {1} |"),
    4: ("| Task | {0} |", "|---|---|", "| MMLU | {1} |"),
    5: ("| Task | {0} |", "|---|---|", "| MMLU | {1} |", "", "## More", "| Task | {0} |", "|---|---|", "| MMLU | {2} |", "| mmlu | {1} |"),
}
_PAPER = {3: ("Table 2: scores", "| Dataset | {0} |", "|---|---|", "| mmlu | {1}.0 |"), 4: ("| Dataset | {0} |", "|---|---|", "| MMLU | {2} |", "| MMLU | {2} |")}


def _written(lines: dict[int, tuple[str, ...]], kind: Column, *values: Column) -> Column:
    def filled(text: str) -> Column:
        out: Column = F.lit(text)
        for i, v in enumerate(values):
            out = F.replace(out, F.lit(f"{{{i}}}"), v)
        return out

    found = F.lit(None).cast("array<string>")
    for k, texts in lines.items():
        found = F.when(kind == k, F.array(*[filled(t) for t in texts])).otherwise(found)
    return found


def _cards(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, target_id, source, text) and targets(doc_id, aliases, stage, own_readme)."""
    key, size = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.lit("M"), key.cast("string"), F.lit("-7B"))
    kind = key % 6
    values = name, size.cast("string"), (size + 1).cast("string")
    each = F.explode(F.array(F.struct(F.lit("readme").alias("source"), _written(_README, kind, *values).alias("lines")), F.struct(F.lit("paper").alias("source"), _written(_PAPER, kind, *values).alias("lines"))))
    docs = dealt(spark, d, "part", "p_partkey").select(key.alias("target_id"), kind.alias("kind"), name.alias("name"), each.alias("e")).where("e.lines is not null")
    doc_id = F.concat_ws(":", "target_id", "e.source")
    alias = F.when(F.col("kind") == 0, F.array(F.concat("name", F.lit("-Base")), F.lit("org/x"))).otherwise(F.array("name"))
    stage = F.when(F.col("kind") == 0, "base").when(F.col("kind") == 1, "post")
    targets = docs.select(doc_id.alias("doc_id"), alias.alias("aliases"), stage.alias("stage"), (F.col("e.source") == "readme").alias("own_readme"))
    return docs.select(doc_id.alias("doc_id"), "target_id", F.col("e.source").alias("source"), F.array_join("e.lines", "\n").alias("text")), targets


def _rows(docs: DataFrame, targets: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    found = scores.target_rows(lines, targets)
    return found.select(F.substring_index("doc_id", ":", 1).cast("long").alias("target_id"), F.substring_index("doc_id", ":", -1).alias("source"), *[c for c in found.columns if c != "doc_id"])


_P = "WITH p AS (SELECT p_partkey AS t, p_partkey % 6 AS k, 'M' || p_partkey || '-7B' AS n, p_size::VARCHAR AS a, (p_size + 1)::VARCHAR AS b FROM part)"
_LEAD = "'Category | Benchmark | Metric | # Shots | ' || n || ' | Other 7B'"
_ROWS = [
    # kind, source, block, row, col, benchmark, score, metric, setting, row_text, header, caption, orientation
    (0, "readme", 0, 2, 4, "'MMLU'", "a", "exact match", "5-shot", "'| General | [MMLU][m] (acc) | EM | 5 | ' || a || ' | 1 |'", _LEAD, "Accuracy, 4-shot", "benchmark_major"),
    (0, "readme", 0, 3, 4, "'ARC'", "b", "accuracy", "4-shot", "'| | ARC | | | ' || b || ' | 2 |'", _LEAD, "Accuracy, 4-shot", "benchmark_major"),
    (2, "readme", 0, 2, 1, "'MMLU'", "a", "exact match", "5-shot", "'| **' || n || ' (ours)** | ' || a || ' | ' || b || ' % | n/a |'", "'Model (em) | MMLU (5-shot) | GSM8K | Note'", "", "model_major"),
    (2, "readme", 0, 2, 2, "'GSM8K'", "b || ' %'", "exact match", "Not specified", "'| **' || n || ' (ours)** | ' || a || ' | ' || b || ' % | n/a |'", "'Model (em) | MMLU (5-shot) | GSM8K | Note'", "", "model_major"),
    (2, "readme", 0, 4, 1, "'MMLU'", "a", "exact match", "5-shot", "'| ' || n || ' | ' || a || ' | n/a | n/a |'", "'Model (em) | MMLU (5-shot) | GSM8K | Note'", "", "model_major"),
    (3, "readme", 0, 2, 1, "'MMLU'", "a", "Not specified", "Not specified", "'| MMLU | ' || a || ' |'", "'Task | ' || n", "", "benchmark_major"),
    (3, "paper", 0, 2, 1, "'mmlu'", "a || '.0'", "Not specified", "Not specified", "'| mmlu | ' || a || '.0 |'", "'Dataset | ' || n", "scores", "benchmark_major"),
    (4, "readme", 0, 2, 1, "'MMLU'", "a", "Not specified", "Not specified", "'| MMLU | ' || a || ' |'", "'Task | ' || n", "", "benchmark_major"),
    (4, "paper", 0, 2, 1, "'MMLU'", "b", "Not specified", "Not specified", "'| MMLU | ' || b || ' |'", "'Dataset | ' || n", "", "benchmark_major"),
    (4, "paper", 0, 3, 1, "'MMLU'", "b", "Not specified", "Not specified", "'| MMLU | ' || b || ' |'", "'Dataset | ' || n", "", "benchmark_major"),
    (5, "readme", 0, 2, 1, "'MMLU'", "a", "Not specified", "Not specified", "'| MMLU | ' || a || ' |'", "'Task | ' || n", "", "benchmark_major"),
    (5, "readme", 1, 2, 1, "'MMLU'", "b", "Not specified", "Not specified", "'| MMLU | ' || b || ' |'", "'Task | ' || n", "", "benchmark_major"),
    (5, "readme", 1, 3, 1, "'mmlu'", "a", "Not specified", "Not specified", "'| mmlu | ' || a || ' |'", "'Task | ' || n", "", "benchmark_major"),
]
_COLUMNS = "t AS target_id, '{1}' AS source, {2} AS block, {3} AS row, {4} AS col, {5} AS benchmark, {6} AS score, '{7}' AS metric, '{8}' AS setting, {9} AS row_text, {10} AS header, '{11}' AS caption, '{12}' AS orientation"
_FOUND = " UNION ALL ".join(f"SELECT {_COLUMNS.format(*r)} FROM p WHERE k = {r[0]}" for r in _ROWS)


@query(f"{_P} {_FOUND}")
def score_rows_of_targets(spark, d):
    """Every score that the tables of two sources give for each model."""
    return _rows(*_cards(spark, d)).withColumn("header", F.array_join("header", " | "))


@query(f"""{_P}, f AS ({_FOUND}),
o AS (SELECT *, lower(benchmark) AS scope, replace(replace(score, ' ', ''), '%', '')::DOUBLE AS v, CASE source WHEN 'readme' THEN 1 ELSE 2 END AS rank FROM f),
g AS (SELECT target_id, scope, setting, count(DISTINCT source) AS n, count(DISTINCT v) AS nv, count(DISTINCT score) AS n_values FROM o GROUP BY ALL),
j AS (SELECT o.*, g.n, g.nv, g.n_values FROM o JOIN g USING (target_id, scope, setting)),
r AS (SELECT *, row_number() OVER (PARTITION BY target_id, scope, setting, CASE WHEN n = 1 THEN score WHEN nv = 1 THEN '' ELSE source || score END ORDER BY rank, block, row, col) AS nth FROM j)
SELECT target_id, source, block, row, col, benchmark, score, metric, setting, orientation, n_values, 'evaluation.benchmark_scores' AS path, CASE WHEN n > 1 AND nv = 1 THEN 'readme|paper' ELSE source END AS sources,
  CASE WHEN n > 1 AND nv > 1 THEN 'withhold' ELSE 'accept' END AS action, CASE WHEN n > 1 AND nv > 1 THEN 'score_conflict_between_sources' ELSE 'structured_table_row_names_target' END AS reason, length(row_text) AS n_quoted
FROM r WHERE nth = 1""")
def score_claims(spark, d):
    """Claims of each model with the sources that state them, held back where sources differ, each with the place of its row."""
    docs, targets = _cards(spark, d)
    found = scores.with_spans(scores.claims(_rows(docs, targets), KINDS), docs)
    return found.select("target_id", "source", "block", "row", "col", "benchmark", "score", "metric", "setting", "orientation", "n_values", "path", F.array_join("sources", "|").alias("sources"), "action", "reason", (F.col("end") - F.col("start")).alias("n_quoted"))
