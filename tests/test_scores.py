from pyspark.sql import functions as F

from cardloom.operators import ledger, scores

DOC = """# Model
## Post-training
| Task | Nova 7B | Other |
|---|---|---|
| MMLU | 60 | 1 |

## Base models

Plain words.

| Benchmark | Dataset | Nova 7B | Nova 8B |
|---|---|---|---|
| General | MMLU (5-shot) | 70.5 | 1 |
| | ARC | n/a | 2 |

## Base models
| Results | Nova 7B | MMLU |
|---|---|---|
| Nova 7B | - | 71 |
"""
ROWS = "doc_id string, aliases array<string>, stage string, own_readme boolean"


def _found(spark, text, *target):
    docs = spark.createDataFrame([("d", text)], "doc_id string, text string")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return scores.target_rows(lines, spark.createDataFrame([("d", *target)], ROWS))


def test_stage_of_the_heading_decides_which_name_counts(spark):
    got = {(r.block, r.benchmark, r.score, r.setting, r.orientation) for r in _found(spark, DOC, ["Nova-7B-Base"], "base", False).collect()}
    # the name's column of the third table gives nothing, so its rows are read across
    assert got == {(1, "MMLU", "70.5", "5-shot", "benchmark_major"), (2, "MMLU", "71", "Not specified", "model_major")}
    got = {(r.block, r.score) for r in _found(spark, DOC, ["Nova-7B-Instruct"], "post", None).collect()}
    assert got == {(0, "60")}
    got = {(r.block, r.score) for r in _found(spark, DOC, ["Nova 7B"], None, None).collect()}
    assert got == {(0, "60"), (1, "70.5"), (2, "71")}


def test_rows_without_text_target_or_table(spark):
    for text in (None, "", "| a |", "no table", "|---|\n|---|", "||\n||\n"):
        assert _found(spark, text, ["Nova 7B"], "base", True).count() == 0
    assert _found(spark, DOC, None, "base", True).count() == 0
    assert _found(spark, DOC, [], "base", True).count() == 0
    assert _found(spark, DOC, [None, ""], None, True).count() == 0


SHAPE = "target_id long, source string, block int, row int, col int, benchmark string, score string, metric string, setting string, row_text string, header array<string>, caption string, orientation string"


def _row(target, source, benchmark, score, setting="Not specified", block=0, row=1):
    return (target, source, block, row, 1, benchmark, score, "m", setting, f"| {benchmark} | {score} |", ["a"], "", "benchmark_major")


def test_claims_of_one_and_of_several_sources(spark):
    rows = [
        _row(1, "readme", "MMLU", "70"), _row(1, "readme", "MMLU", "70", row=2), _row(1, "readme", "MMLU", "71", row=3),  # one source: all distinct scores
        _row(2, "paper", "MMLU", "70.0"), _row(2, "readme", "mmlu!", "70"), _row(2, "readme", "MMLU", "70", "5-Shot"), _row(2, "paper", "MMLU", "70", "5-shot"),  # agreed twice
        _row(3, "readme", "MMLU", "70"), _row(3, "paper", "MMLU", "71"), _row(3, "paper", "MMLU", "71", row=5),  # conflict, a repeat counts once
        _row(4, "readme", "MMLU", "7±1"), _row(4, "paper", "MMLU", "7±1"),  # no numbers, equal texts
        _row(5, "readme", "MMLU", "7±1"), _row(5, "paper", "MMLU", "7"),  # a text and a number
        _row(6, "blog", "MMLU", "7"), _row(6, None, "MMLU", "7"),  # no known sources
    ]
    found = scores.claims(spark.createDataFrame(rows, SHAPE), ("readme", "paper")).collect()
    got = sorted((r.target_id, r.source, r.score, r.setting, tuple(r.sources), r.n_values, r.action) for r in found)
    both = ("readme", "paper")
    assert got == [
        (1, "readme", "70", "Not specified", ("readme",), 2, "accept"), (1, "readme", "71", "Not specified", ("readme",), 2, "accept"),
        (2, "readme", "70", "5-Shot", both, 1, "accept"), (2, "readme", "70", "Not specified", both, 2, "accept"),
        (3, "paper", "71", "Not specified", ("paper",), 2, "withhold"), (3, "readme", "70", "Not specified", ("readme",), 2, "withhold"),
        (4, "readme", "7±1", "Not specified", both, 1, "accept"),
        (5, "paper", "7", "Not specified", ("paper",), 2, "withhold"), (5, "readme", "7±1", "Not specified", ("readme",), 2, "withhold"),
    ]
    assert scores.claims(spark.createDataFrame([], SHAPE), ("readme",)).count() == 0


def test_a_claim_stands_only_where_its_row_does(spark):
    found = scores.claims(spark.createDataFrame([_row(1, "readme", "MMLU", "70"), _row(1, "readme", "ARC", "5")], SHAPE), ("readme",))
    texts = spark.createDataFrame([(1, "readme", "x\n|  MMLU |\t70 |"), (2, "readme", None)], "target_id long, source string, text string")
    assert [(r.benchmark, r.start, r.end) for r in scores.with_spans(found, texts).collect()] == [("MMLU", 2, 15)]


def test_reconcile_of_scores_that_are_no_numbers(spark):
    rows = [("a", "x", "7±1"), ("a", "y", "7±1"), ("b", "x", "7±1"), ("b", "y", "7"), ("c", "x", "7"), ("c", "y", "7.0")]
    got = {r.scope: r.status for r in ledger.reconcile(spark.createDataFrame(rows, "scope string, source string, score string")).collect()}
    assert got == {"a": "agreed", "b": "score_conflict_between_sources", "c": "agreed"}
