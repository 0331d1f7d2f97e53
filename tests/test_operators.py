import hashlib

from pyspark.sql import functions as F

from cardloom.functions import text as T
from cardloom.operators import evidence, gates, ledger, metrics, tables

OLMO = """Scores below.

| Model | MMLU (5-shot) | GSM8K | HumanEval |
|---|---|---|---|
| **OLMo 2 7B** | 63.7 | 67.5 | 20.1 |
| Llama 3.1 8B | 66.7 | 56.0 | 33.5 |
"""
COST = "| Model | GPU hours | MWh |\n|---|---|---|\n| OLMo 2 7B | 131 | 1.2 |\n"
ACROSS = "| Benchmark | OLMo 2 7B | Other |\n|---|---|---|\n| MMLU | 63.7 | 1.0 |\n| layers | 32 | 40 |\n| ARC | n/a | 2 |\n"


def test_score_rows_of_each_kind_of_table(spark):
    docs = spark.createDataFrame([("a", OLMO), ("b", COST), ("c", ACROSS), ("d", None)], "doc_id string, text string")
    aliases = spark.createDataFrame([(d, a) for d in "abcd" for a in ("OLMo-2-1124-7B", "OLMo 2 7B")], "doc_id string, alias string")
    got = {(r.doc_id, r.benchmark, r.score, r.setting, r.orientation) for r in tables.score_rows(docs, aliases).collect()}
    assert got == {("a", "MMLU", "63.7", "5-shot", "row"), ("a", "GSM8K", "67.5", "Not specified", "row"), ("a", "HumanEval", "20.1", "Not specified", "row"), ("c", "MMLU", "63.7", "Not specified", "column")}


def test_metric_and_setting(spark):
    df = spark.createDataFrame([("HumanEval pass@1",), ("GSM8K 8-shot CoT",), ("top-5 acc",), ("chain-of-thought F1",), ("plain",)], "t string")
    got = [tuple(r) for r in df.select(T.metric(F.col("t")), T.setting(F.col("t"))).collect()]
    assert got == [("pass@1", "Not specified"), ("Not specified", "8-shot CoT"), ("accuracy", "Not specified"), ("F1", "chain-of-thought"), ("Not specified", "Not specified")]


def test_normalized_and_plain_view(spark):
    df = spark.createDataFrame([("a  “b”　c\n",)], "t string")
    assert df.select(T.normalized(F.col("t"))).first()[0] == 'a "b" c'
    md = spark.createDataFrame([("**Bold** [text](u) ![alt](i) `code` <b>x</b> <https://a.b> *it* R&amp;D<!-- no -->",)], "t string")
    assert md.select(T.markdown_plain(F.col("t"))).first()[0].replace("  ", " ") == "Bold text alt code x https://a.b it R&D".replace("  ", " ")


def test_quotes_offsets_and_short_quotes(spark):
    quotes = spark.createDataFrame([(1, "a  quick brown"), (2, "fox"), (3, "never there now"), (4, "")], "quote_id long, quote string")
    docs = spark.createDataFrame([(10, "see a quick\nbrown fox"), (11, None)], "source_id long, text string")
    hits = evidence.verify_quotes(quotes, docs)
    assert {tuple(r) for r in hits.drop("s").collect()} == {(1, 10, 4, 17), (2, 10, 18, 21)}
    assert [r.quote_id for r in evidence.unverified(quotes, hits).collect()] == [3, 4]


def test_gate_order(spark):
    policy = gates.field_policy(spark)
    assert policy.count() == 34
    base = dict(other_stage=False, roster=False, has_family=True, comparison=False, base_checkpoint=False, tier="x", names_target=True)
    rows = [
        base | dict(field="lineage.base_models", relation="exact_target", other_stage=True),
        base | dict(field="identity.summary", relation="exact_target", other_stage=True),
        base | dict(field="evaluation.benchmark_scores", relation="base"),
        base | dict(field="evaluation.benchmark_scores", relation="exact_target", names_target=False),
        base | dict(field="training_context.training_data", relation="family"),
        base | dict(field="training_context.training_data", relation="family", base_checkpoint=True, tier="introduces_target"),
        base | dict(field="specifications.num_parameters", relation="unknown"),
        base | dict(field="identity.summary", relation="family"),
    ]
    got = {(r.field, r.relation, r.base_checkpoint, r.names_target): r.reason for r in gates.gate(spark.createDataFrame(rows), policy).collect()}
    assert got["lineage.base_models", "exact_target", False, True] == "lineage_is_structured_channel_only"
    assert got["identity.summary", "exact_target", False, True] == "sentence_about_the_other_stage"
    assert got["evaluation.benchmark_scores", "base", False, True] == "score_of_base_not_this_checkpoint"
    assert got["evaluation.benchmark_scores", "exact_target", False, False] == "score_row_does_not_name_the_target"
    assert got["training_context.training_data", "family", False, True] == "family_statement_not_this_checkpoint"
    assert got["training_context.training_data", "family", True, True] is None
    assert got["specifications.num_parameters", "unknown", False, True] == "numeric_value_of_unknown_not_this_checkpoint"
    assert got["identity.summary", "family", False, True] is None


def test_reconcile_needs_numeric_agreement(spark):
    rows = [("a", "x", "63.70"), ("a", "y", "63.7%"), ("b", "x", "1"), ("b", "y", "2"), ("c", "x", "5"), ("c", "x", "6")]
    got = {r.scope: r.status for r in ledger.reconcile(spark.createDataFrame(rows, "scope string, source string, score string")).collect()}
    assert got == {"a": "agreed", "b": "score_conflict_between_sources", "c": "single_source"}


def test_effective_keeps_an_explicit_null(spark):
    rows = [("k", 1, "reassign", "v", True), ("k", 2, "reassign", None, True), ("k", 3, "accept", "ignored", False)]
    df = spark.createDataFrame(rows, "k string, seq int, action string, v string, is_set boolean")
    assert tuple(ledger.effective(df, "k", ["seq"], "action", "v", F.col("is_set")).first()) == ("k", "accept", True, None)


def test_greedy_pack_skips_and_goes_on(spark):
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate([50, 60, 40, 500, 10])], "k string, i int, n long")
    assert tuple(ledger.greedy_pack(df, "k", ["i"], "n", 100, 90).first()) == ("k", 100, 3, 2)


def test_filled_knows_both_signs_of_absence(spark):
    df = spark.createDataFrame([("x",), ("Not specified",), ("Not applicable",), (None,), ("[]",)], "v string")
    assert [r[0] for r in df.select(metrics.filled(F.col("v"))).collect()] == [True, False, False, False, False]


def test_tiered_join_is_never_fuzzy(spark):
    left = spark.createDataFrame([("A/b",), ("a/B",), ("a/bb",)], "id string")
    right = spark.createDataFrame([("A/b", 1)], "id string, n int")
    assert {tuple(r) for r in ledger.tiered_join(left, right, "id", "n").collect()} == {("A/b", 1, "exact"), ("a/B", 1, "case_insensitive"), ("a/bb", None, "none")}


def test_copied_runs_in_any_script(spark):
    cyrillic = "один два три четыре пять шесть семь восемь девять десять одиннадцать двенадцать"
    chinese = "我们在大规模语料上训练这个模型并且在许多任务上评估它的表现和局限"
    accents = "é ü ö ä ñ ç å ø ê î ô û"
    values = [(1, f"нет {cyrillic} конец"), (2, f"注{chinese}"), (3, accents.upper()), (4, chinese[:23]), (5, "one two three"), (6, None), (7, "a b c d e f g h i j k ｌ")]
    sources = [(10, f"x, {cyrillic.upper()}!"), (11, f"前文。{chinese[:12]}，{chinese[12:]}。"), (12, accents), (13, None), (14, "A-B-C-D-E-F-G-H-I-J-K-L")]
    v, s = spark.createDataFrame(values, "value_id long, text string"), spark.createDataFrame(sources, "source_id long, text string")
    assert {tuple(r) for r in evidence.copied_runs(v, s).collect()} == {(1, 10, 1), (2, 11, 1), (3, 12, 0), (7, 14, 0)}


def test_large_groups_are_not_gathered(spark):
    from cardloom.plans import catalogue

    for name in ("bundle_digest", "budget_greedy_pack", "table_islands", "table_scores_model_major"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan, name


def test_folds_of_null_and_several_keys(spark):
    rows = [("a", 2, "x", 60), ("a", 1, None, 50), (None, 1, "y", 10), ("b", 5, None, None), ("a", 3, "z", 40), ("a", 4, "z", 200)]
    df = spark.createDataFrame(rows, "k string, i long, t string, n long")
    assert {tuple(r) for r in ledger.greedy_pack(df, "k", ["i"], "n", 100, 90).collect()} == {("a", 90, 2, 2), (None, 10, 1, 0), ("b", 0, 0, 0)}
    h = lambda t: hashlib.md5(t.encode()).hexdigest()
    of = lambda t: "bundle_" + hashlib.sha256(t.encode()).hexdigest()[:32]
    assert {tuple(r) for r in ledger.bundles(df, "k", "i", "t").collect()} == {("a", of(f"2:{h('x')}\n3:{h('z')}\n4:{h('z')}"), 4), (None, of(f"1:{h('y')}"), 1), ("b", None, 1)}


def test_rows_wider_than_ten_thousand_columns(spark):
    n = 10_050
    text = "\n".join("| " + " | ".join(x) + " |" for x in (["Model", *(f"MMLU {i}" for i in range(n))], ["---"] * (n + 1), ["OLMo", *(str(i) for i in range(n))]))
    got = tables.score_rows(spark.createDataFrame([("a", text)], "doc_id string, text string"), spark.createDataFrame([("a", "OLMo")], "doc_id string, alias string"))
    assert {r.score for r in got.select("score").collect()} == {str(i) for i in range(n)}


def test_a_run_of_every_source_goes_on_once(spark):
    run = "licensed under the terms that this file names in its first line"
    values = spark.range(50).select(F.col("id").alias("value_id"), F.concat(F.lit("start "), F.lit(run)).alias("text"))
    sources = spark.range(40).select((F.col("id") + 7).alias("source_id"), F.lit(run.upper()).alias("text"))
    found = evidence.copied_runs(values, sources)
    assert {tuple(r) for r in found.collect()} == {(i, 7, 1) for i in range(50)}
    assert {tuple(r) for r in evidence.copied_runs(values, sources.where("false")).collect()} == set()


def test_quotes_meet_on_their_rarest_word(spark):
    docs = [(i, f"x the common-word-of-all w{i} here and the common-word-of-all again") for i in range(70)] + [(99, ""), (100, None)]
    quotes = [(i, f"the common-word-of-all w{i} here") for i in range(70)] + [(i, f"all  w{i - 100} he") for i in range(100, 170)] + [(200, "the common-word-of-all w1x here"), (201, "all w3")] + [(300 + i, "and the common-word-of-all again") for i in range(70)]
    s = spark.createDataFrame(docs, "source_id long, text string")
    got = sorted(tuple(r) for r in evidence.verify_quotes(spark.createDataFrame(quotes, "quote_id long, quote string"), s).drop("s").collect())
    plain = [(k, j, t.find(" ".join(q.split()))) for k, q in quotes for j, t in docs if t]
    assert got == sorted((k, j, at, at + len(" ".join(q.split()))) for (k, j, at) in plain if at >= 0 for q in [dict(quotes)[k]])


def test_white_space_of_any_kind_is_one_space(spark):
    texts = ["a b", " a  b ", "a\tb\t c", "a \t b", " a b　", "a \nb c", "", "\t"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.normalized(F.col("t"))).collect()]
    assert got == [" ".join(t.split()) for t in texts]
