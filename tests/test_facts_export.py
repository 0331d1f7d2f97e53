from pyspark.sql import functions as F

from cardloom.operators import export, facts, gates


def test_facts_need_their_needle(spark):
    s = spark.createDataFrame([("t", '{"max": 4096, "license": "mit"}', 4096, "gpl")], "target string, text string, n int, lic string")
    got = facts.structured_facts(s, {"context_length": (F.col("n"), F.col("n")), "license": (F.col("lic"), F.col("lic")), "none": (F.lit(None), F.lit("mit"))}).collect()
    assert [tuple(r) for r in got] == [("t", "context_length", "4096", "4096", 8)]
    cfg = spark.createDataFrame([("llama", "LlamaForCausalLM", None), ("x", "Y", 8), ("mamba2", "Z", None), ("t5", "T5ForConditionalGeneration", None), ("q", "Q", None)], "m string, a string, e int")
    kinds = [r[0] for r in cfg.select(facts.architecture({"model_type": F.col("m"), "architecture": F.col("a"), "experts": F.col("e")})).collect()]
    assert kinds == ["dense decoder-only", "mixture-of-experts", "state-space", None, None]


def test_leaves_and_claims(spark):
    v = spark.createDataFrame([(1, "Trained on 2T tokens of Sol-8B", "It saw 2 trillion tokens", ["Sol-8B-v2"]), (2, "Uses 32 layers and GPT4x", "Uses 16 layers", [])], "binding_id int, value string, evidence string, established array<string>")
    assert {tuple(r) for r in facts.unsupported_leaves(v).collect()} == {(2, "32.0"), (2, "gpt4x")}
    cells = spark.createDataFrame([("t", "f", "One is. Two was!")], "target string, field string, value string")
    ctx = spark.createDataFrame([("t", "f", "b"), ("t", "f", "a"), ("t", "g", "c")], "target string, field string, context string")
    assert [tuple(r) for r in facts.claims(cells, ctx).orderBy("n").collect()] == [("t", "f", 0, "One is.", ["a", "b"]), ("t", "f", 1, "Two was!", ["a", "b"])]


def test_completer_is_any_function(spark):
    def scripted(prompt, most):
        if prompt == "bad":
            raise ValueError
        return prompt.upper() + " word" * (most if prompt == "long" else 0)

    got = {tuple(r) for r in facts.complete(spark.createDataFrame([("1", "hi"), ("2", "bad"), ("3", "long")], "key string, prompt string"), scripted, 4).collect()}
    assert got == {("1", "HI", False), ("2", None, False), ("3", "LONG word word word word", True)}


def test_cards(spark):
    policy = gates.field_policy(spark)
    cells = spark.createDataFrame([("m", "identity.name", "No|va"), ("m", "identity.version", "Not specified"), ("m", "links.citation", "see /home/me/x")], "target string, field string, value string")
    card = export.render(cells, policy).first()
    assert card.markdown == "# m\n\n## Identity\n\n- **name**: No\\|va\n\n## Links\n\n- **citation**: see /home/me/x\n\nUnavailable: identity.version\n" and card.unavailable == 1 and len(card.sha256) == 64
    src = spark.createDataFrame([("s", "zero " + " ".join(f"w{i}" for i in range(14)))], "source_id string, text string")
    prose = spark.createDataFrame([("m", "identity.summary", "x " + " ".join(f"w{i}" for i in range(12)))], "target string, field string, value string")
    got = {tuple(r) for r in export.refusals(cells.unionByName(prose), src).collect()}
    assert got == {("m", "links.citation", "sensitive_text"), ("m", "identity.summary", "prose_reproduces_source_excerpt")}


def test_each_kind_of_private_text_holds_a_card_back(spark):
    held = ["/Users/x", "see /home/me", "C:\\Users\\x", "in ~/notes", "file://x", "a .cache/ here", ".venv/lib", ".pyenv\\x", "the vault/ folder".replace("the ", "/"), "attachments/1", "run-state", "openrouter", "api_key", "Bearer abc", "hf_" + "a" * 24, "localhost", "127.0.0.1", "https://me:pw@host/x"]
    fine = ["me@host.org", "licensed under MIT", "a vaulted roof", "cache and venv", "https://host/x@y"]
    cells = spark.createDataFrame([(str(i), "identity.name", v) for i, v in enumerate(held + fine)], "target string, field string, value string")
    none = spark.createDataFrame([], "source_id long, text string")
    assert {int(r["target"]) for r in export.refusals(cells, none).collect()} == set(range(len(held)))
