from pyspark.sql import functions as F

from cardloom.functions import names as N
from cardloom.operators import frame, gates, validate


def test_referents(spark):
    nodes = spark.createDataFrame([("t", "target", "target", "Nova-7B", ["Nova 7B"]), ("t", "fam", "family", "Nova", []), ("t", "base", "base", "Sol-8B", []), ("t", "cmp", "comparison", "Rex", [])], "target string, id string, type string, name string, aliases array<string>")
    quotes = [
        "Our model beats Rex.", "Nova 7B, Sol-8B and Rex were run.", "Rex is behind Nova-7B here.", "Sol-8B has 32 layers.", "It was trained using Sol-8B data.", "Nova is a family.",
        "The instruct models do more.", "Both base and instruct models do more.",
    ]
    rows = [("t", i, q, "x", "target", "base") for i, q in enumerate(quotes)]
    records = spark.createDataFrame(rows, "target string, record_id int, quote string, referent string, default_referent string, stage string")
    got = {r.record_id: (r.resolved, r.comparison, r.roster, r.other_stage) for r in frame.resolve(records, nodes).collect()}
    assert got == {
        0: ("target", False, False, False), 1: ("x", True, True, False), 2: ("x", True, False, False), 3: ("base", False, False, False), 4: ("base", False, False, False), 5: ("fam", False, False, False),
        6: ("x", False, False, True), 7: ("x", False, False, False),
    }
    hits = {(r.record_id, r.id) for r in frame.mentions(records, nodes).collect()}
    assert (1, "fam") not in hits and (5, "fam") in hits  # the longest name counts


def test_nodes_and_probes(spark):
    tags = spark.createDataFrame([("t", "a/b"), ("t", "finetune:a/b"), ("t", "c/d")], "target string, tag string")
    assert {tuple(r) for r in frame.base_nodes(tags).collect()} == {("t", "a/b", "finetune"), ("t", "c/d", "base")}
    nodes = spark.createDataFrame([("t", "x", "base", "X", ["b"], 1), ("t", "x", "family", "Y", ["a", "b"], 2)], "target string, id string, type string, name string, aliases array<string>, seq int")
    assert tuple(frame.merge_nodes(nodes).first()) == ("t", "x", "base", "X", ["a", "b"])
    lines = spark.createDataFrame([(1, "other", "has 4096 tokens"), (2, "target", "has 8192 tokens"), (3, "rex", "4096 too")], "line_id int, owner string, text string")
    values = spark.createDataFrame([("f", "4096"), ("f", "8192")], "field string, token string")
    assert [tuple(r) for r in frame.splice_probes(values, lines).collect()] == [("f", "4096", 2, "moderate")]


def test_checks(spark):
    rows = [(1, "a/b", "main", "0" * 40), (2, "ab", "x@y", "short"), (3, "a/b--c", None, "f" * 40)]
    df = spark.createDataFrame(rows, "id int, model_id string, requested_revision string, resolved_revision string")
    got = {tuple(r) for r in validate.violations(df, "id", validate.target_checks()).collect()}
    assert got == {(2, "model_id_shape"), (2, "revision_has_at"), (2, "resolved_not_a_commit"), (3, "model_id_shape")}
    spans = [(1, "abc", 0, 3, None, None, None, None), (2, "abc", 0, 4, None, None, "r", []), (3, None, None, None, "/a", None, None, None), (4, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(spans, "id int, exact_text string, start int, end int, json_pointer string, fragment string, row_anchor string, table_header array<string>")
    got = {tuple(r) for r in validate.violations(df, "id", validate.span_checks()).collect()}
    assert got == {(2, "length_differs"), (2, "row_without_header"), (3, "fragment_missing"), (4, "text_or_pointer")}
    b = [(1, "accept", "unknown", "t", "t", "identity.name", None, None), (2, "accept", "exact_target", "o", "t", "evaluation.benchmark_scores[0]", "s", None), (3, "withhold", "unknown", "t", "t", "x", None, None)]
    df = spark.createDataFrame(b, "id int, action string, relation string, entity string, target string, field string, scope string, row_anchor string")
    got = {tuple(r) for r in validate.violations(df, "id", validate.binding_checks()).collect()}
    assert got == {(1, "unknown_not_withheld"), (2, "exact_target_is_other"), (2, "score_without_anchor")}
    s = spark.createDataFrame([(1, "collected", "h", None, 1), (2, "collected", None, "r", 1), (3, "missing", None, None, -1)], "id int, status string, sha256 string, reason string, size_bytes int")
    got = {tuple(r) for r in validate.violations(s, "id", validate.source_checks()).collect()}
    assert got == {(2, "collected_without_hash"), (2, "collected_with_reason"), (3, "absent_without_reason"), (3, "size_is_negative")}
    assert [r.id for r in validate.repeated(s.unionByName(s.where("id = 1")), ["id"]).collect()] == [1]
    cells = spark.createDataFrame([("c", f"{k}.{f}") for k, fs in gates.FIELDS.items() for f in fs if f != "name"] + [("c", "extra.field")], "card string, field string")
    assert {tuple(r) for r in validate.contract_gaps(cells, gates.field_policy(spark), "card").collect()} == {("c", "identity.name", "missing"), ("c", "extra.field", "extra")}


def test_names(spark):
    df = spark.createDataFrame([("Org/Nova-7B-Instruct", 404, " 'MIT' ", "docs/Model.MD", 30, 10, "bf16", ["a", "b"])], "n string, s int, d string, f string, b long, p long, t string, l array<string>")
    c = F.col
    row = df.select(
        N.pair_stem(c("n")), N.stage(c("n")), N.card_name(c("n")), N.distinctive_tokens(c("n")), N.outcome(c("s")), N.declared(c("d")), N.media_type(c("f")), N.size_contradicts(c("b"), c("p"), c("t")),
        N.set_at(c("l"), F.lit(2), F.lit("c")), N.remove_at(c("l"), F.lit(0)), N.field_path(F.lit("a.b[1][2]")), N.field_path(F.lit("nope")), N.short(F.lit("x  y")), N.escape_markdown(F.lit("a<b|c\nd")), N.modalities(F.lit("text-to-image")),
        N.relevant_file(F.lit("docs/README.md"), ["config.json"], ["readme"]),
    ).first()
    assert list(row) == ["Org/Nova-7B", "post", "nova-7b-instruct", ["org", "nova"], "missing", "MIT", "text/markdown", False, ["a", "b", "c"], ["b"], ("a.b", [1, 2]), None, "x y", "a&lt;b\\|c<br>d", ["input: text", "output: image"], True]


def test_sentences_of_both_stages_and_credits(spark):
    from pyspark.sql import functions as F

    from cardloom.functions import text as T
    from cardloom.operators import facts, frame

    def stage_of(kind, quote):
        return spark.createDataFrame([(kind, quote)], "s string, q string").select(frame.other_stage(F.col("s"), F.col("q"))).first()[0]

    assert not stage_of("base", "open weights for both pre-trained variants and instruction-tuned variants.")
    assert not stage_of("base", "the pretrained and instruction-tuned checkpoints")
    assert not stage_of("post", "chat models as well as base models")
    assert stage_of("base", "The instruction-tuned text only models are optimized for dialogue.")
    nodes = spark.createDataFrame([("t", "target", "target", "gem-9b", []), ("t", "c", "comparison", "Star", [])], "target string, id string, type string, name string, aliases array<string>")
    quotes = ["Open models, built from the same research and technology used to create the Star models.", "Star was made with care.", "It is using Star as a judge."]
    records = spark.createDataFrame([("t", i, q, "target", "target", "base") for i, q in enumerate(quotes)], "target string, record_id int, quote string, referent string, default_referent string, stage string")
    assert {r.record_id: r.resolved for r in frame.resolve(records, nodes).collect()} == {0: "target", 1: "c", 2: "c"}
    leaks = spark.createDataFrame([("see ~/notes",), ("in .cache/hub",), ("my .venv/bin",), ("a vault of gold",), ("plain",)], "t string")
    assert [len([k for k, p in T.SENSITIVE.items() if k != "license" and leaks.where(F.col("t").rlike(f"(?i){p}")).where(F.col("t") == r.t).count()]) for r in leaks.collect()] == [1, 1, 1, 0, 0]
    kinds = [("llama", None, None), (None, "MixtralForCausalLM", 8), ("whisper", "WhisperForConditionalGeneration", None), (None, "MambaForCausalLM", None), (None, "XForCausalLM", 0), (None, None, None)]
    df = spark.createDataFrame(kinds, "model_type string, architecture string, experts int")
    got = [r[0] for r in df.select(facts.architecture({c: F.col(c) for c in df.columns})).collect()]
    assert got == ["dense decoder-only", "mixture-of-experts", "encoder-decoder", "state-space", "dense decoder-only", None]
