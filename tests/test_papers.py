import pytest
from pyspark.sql import functions as F

from cardloom.operators import papers as P


def _ask(spark, column, rows, names):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {names}")
    return [r[0] for r in df.select(column.alias("x"), "i").orderBy("i").select("x").collect()]


def test_names(spark):
    names = ["meta-llama/Meta-Llama-3.1-8B", "jay/qwen2.5-0.5b-sft-mdpo", "deepseek-ai/DeepSeek-V3", "google/gemma-7b", "mistralai/Mistral-7B-v0.3", "org/", "", None, "it-7b", "a/kimi-k2"]
    m = F.col("m")
    rows = [(n,) for n in names]
    assert _ask(spark, P.head_word(m), rows, "m string") == ["llama", "qwen2", "deepseek", "gemma", "mistral", None, None, None, None, "kimi"]
    assert _ask(spark, P.generation(m, P.head_word(m)), rows, "m string") == ["3.1", "2.5", "3", None, None, None, None, None, None, None]
    forms = _ask(spark, P.name_forms(m), rows, "m string")
    assert forms[0] == ["llama 3", "llama-3", "llama3"] and forms[3] == ["gemma 7b", "gemma-7b", "gemma7b"] and forms[5] == []
    names = ["Qwen3-8B-Base", "Llama-3.1-8B-Instruct", "DeepSeek-V3-Base", "OLMo-2-1124-7B", "gemma-3-4b-it", "mistral-inference", "llama-models", "Mistral-7B-v0.3", "gemma-2024", ""]
    assert _ask(spark, P.version(m), [(n,) for n in names], "m string") == ["3", "3.1", "3", "2", "3", None, None, None, None, None]


GATE = [
    ("meta-llama/Llama-3.2-3B", "The Llama 3 Herd of Models", True),
    ("meta-llama/Llama-3.2-3B", "Llama-3.1-Foundation-SecurityLLM-8B Technical Report", False),
    ("meta-llama/Llama-3.2-3B", "Lawyer LLaMA Technical Report", False),
    ("meta-llama/Llama-3.2-3B", "Code Llama: Open Foundation Models for Code", False),
    ("meta-llama/Llama-3.2-3B", "LLaMA-Adapter: Efficient Fine-tuning of Language Models", False),
    ("meta-llama/Llama-3.2-3B", "Llama 2: Open Foundation and Fine-Tuned Chat Models", False),
    ("meta-llama/Llama-3.2-3B", "Attacks on Llama 3: a study", False),
    ("meta-llama/Meta-Llama-3.1-8B", "Evolution of meta's llama models", False),
    ("meta-llama/Llama-3.1-8B", "LLaMA: Open and Efficient Foundation Language Models", False),
    ("Qwen/Qwen2.5-32B-Instruct", "Qwen2.5 Technical Report", True),
    ("Qwen/Qwen2-72B", "Qwen2.5 Technical Report", False),
    ("Qwen/Qwen2-57B-A14B", "Qwen2 Technical Report", True),
    ("Qwen/Qwen2-57B-A14B", "Qwen2.5-Math Technical Report", False),
    ("Qwen/Qwen2.5-Math-7B", "Qwen2.5-Math Technical Report", True),
    ("Qwen/Qwen2.5-32B", "Qwen2.5-1M Technical Report", False),
    ("google/gemma-7b", "Gemma: Open Models Based on Gemini", True),
    ("google/gemma-7b", "Gemma 2: Improving Open Language Models", False),
    ("google/gemma-3-4b-it", "Gemma 30 Technical Report", False),
    ("google/gemma-3-4b-it", "Gemma 3 Technical Report", True),
    ("deepseek-ai/DeepSeek-V3", "DeepSeek-V3 Technical Report", True),
    ("mistralai/Mistral-7B-v0.3", "Mistral 7B", True),
    ("mistralai/Mistral-7B-v0.3", "Mistral-7B", True),
    ("moonshotai/kimi-k2-instruct", "Kimi K2: Open Agentic Intelligence", True),
    ("a/nova-2-7b", "Nova 2 and the Nova 3", True),
    ("a/nova-3-7b", "Nova 2 and the Nova 3", False),
    ("a/nova-3-7b", "Presenting:\nNova v3", True),
    ("a/nova-3-7b", "", False), ("a/nova-3-7b", None, False), (None, "Nova 3", False), ("7b", "7b", False),
]


def test_gate(spark):
    got = _ask(spark, P.title_gate(F.col("m"), F.col("t"), F.lit(None).cast("array<string>")), [(m, t) for m, t, _ in GATE], "m string, t string")
    assert [(m, t, x) for (m, t, _), x in zip(GATE, got, strict=True)] == GATE
    rows = [("x/Tuned-8B", "The Nova 3 Herd", ["org/Nova-3.1-8B", None, "bare-3"]), ("x/Tuned-8B", "Bare 3", ["bare-3"])]
    assert _ask(spark, P.title_gate(F.col("m"), F.col("t"), F.col("b")), rows, "m string, t string, b array<string>") == [True, False]


@pytest.mark.parametrize(("model", "title", "abstract", "bases", "want"), [
    ("allenai/OLMo-2-1124-7B", "2 OLMo 2 Furious", "we present OLMo 2", None, 0),
    ("meta-llama/Llama-3.1-8B-Instruct", "The Llama 3 Herd of Models", "", None, 0),
    ("Qwen/Qwen3-8B-Base", "Qwen3 Technical Report", None, None, 0),
    ("acme/Llama-3.1-8B-Instruct-Finetune-Med", "The Llama 3 Herd of Models", "", None, 1),
    ("acme/MedTune-8B", "The Llama 3 Herd of Models", "", ["meta-llama/Llama-3.1-8B"], 1),
    ("acme/MedTune-8B", "The Llama 3 Herd of Models", "", ["llama-3"], 2),
    ("Qwen/Qwen3-8B", "YaRN: Efficient Context Window Extension", "We present YaRN.", [], 2),
    ("google/gemma-3-4b-pt", "IndicGenBench", "including palm-2, mt5, gemma, bloom and llama", None, 1),
    ("acme/Zed-8B", "A paper", "we release zed 8B here", None, 0), (None, None, None, None, 2), ("", "x", "y", None, 2),
])
def test_tiers(spark, model, title, abstract, bases, want):
    got = _ask(spark, P.tier(F.col("m"), F.col("t"), F.col("a"), F.col("b")), [(model, title, abstract, bases)], "m string, t string, a string, b array<string>")
    assert got == [P.TIERS[want]]


def test_searches(spark):
    rows = [("google/gemma-2-9b", None), ("a/Nova-3-8B-Instruct", ["b/nova-3-8B", "c/Other-1-7B", None, "bare"])]
    got = _ask(spark, P.searches(F.col("m"), F.col("b")), rows, "m string, b array<string>")
    assert got == [["gemma 2 technical report", "gemma 2 language model"], ["Nova 3 technical report", "Nova 3 language model", "Other 1 technical report"]]


README = "# M\n[report](https://arxiv.org/abs/2505.09388) https://arxiv.org/pdf/2401.00001v2\n```bibtex\n@misc{q,\n  title={T},\n  eprint={2505.09388},\n  note={arXiv:2402.11111}\n}\n```\n"


def test_arxiv_numbers(spark):
    rows = [(["arxiv:2309.00071", "x", None, "ArXiv:2309.00071v3"], README), (None, None), ([], "")]
    got = _ask(spark, P.arxiv_numbers(F.col("tags"), F.col("readme")), rows, "tags array<string>, readme string")
    assert [tuple(x) for x in got[0]] == [("2309.00071", "hf_arxiv_tag"), ("2505.09388", "readme_bibtex"), ("2402.11111", "readme_bibtex"), ("2401.00001", "readme_link")]
    assert got[1:] == [[], []]


def test_choice_of_papers(spark):
    shape = "target int, model string, bases array<string>, seq int, arxiv_id string, title string, abstract string, origin string, searched boolean"
    rows = [
        (1, "a/Nova-3-8B", None, 0, "1", "YaRN", "", "tag", False), (1, "a/Nova-3-8B", None, 1, "2", "On nova", "", "tag", None), (1, "a/Nova-3-8B", None, 3, "4", "Nova 3", "", "search", True), (1, "a/Nova-3-8B", None, 2, "3", "Code Nova 3", "", "search", True),
        (2, "a/Nova-3-8B", None, 0, "1", "Code Nova 3", None, "search", True), (3, "a/Nova-3-8B", None, 0, "1", "a nova", None, "tag", False), (3, "a/Nova-3-8B", None, 0, "0", "a nova", None, "tag", False),
    ]
    got = sorted(tuple(r) for r in P.choose_papers(spark.createDataFrame(rows, shape)).collect())
    assert got == [(1, "4", "Nova 3", "search", "introduces_target"), (3, "0", "a nova", "tag", "family_reference")]
    assert P.choose_papers(spark.createDataFrame([], shape)).count() == 0


def test_repositories(spark):
    rows = [
        ("deepseek-ai/DeepSeek-V3", "https://github.com/deepseek-ai/DeepSeek-V2", False), ("deepseek-ai/DeepSeek-V3", "https://github.com/deepseek-ai/DeepSeek-V3.git", True),
        ("google/gemma-3-4b-pt", "https://github.com/google-research-datasets/natural-questions", False), ("Qwen/Qwen3-8B", "https://github.com/QwenLM/Qwen2.5", False), ("Qwen/Qwen3-8B", "https://GitHub.com/QwenLM/Qwen3", True),
        ("allenai/OLMo-2-1124-7B", "https://github.com/allenai/OLMo-core", True), ("acme/MedTune-8B", "https://github.com/huggingface/peft", False), ("mistralai/Mistral-7B-v0.3", "https://github.com/mistralai/mistral-inference", True),
        ("a/Nova", "https://example.org/nova", False), ("a/Nova", None, False), (None, "https://github.com/a/b", False),
    ]
    assert _ask(spark, P.own_repository(F.col("m"), F.col("u")), [r[:2] for r in rows], "m string, u string") == [r[2] for r in rows]
    links = [(1, "Qwen/Qwen3-8B", 0, "see https://github.com/QwenLM/Qwen3-Coder)."), (1, "Qwen/Qwen3-8B", 1, "https://github.com/QwenLM/Qwen3.git"), (1, "Qwen/Qwen3-8B", 2, "https://github.com/qwenlm/qwen3"), (2, "Qwen/Qwen3-8B", 0, None)]
    got = [tuple(r) for r in P.own_repositories(spark.createDataFrame(links, "target int, model string, seq int, url string")).orderBy("rank").collect()]
    assert got == [(1, "https://github.com/QwenLM/Qwen3", 1), (1, "https://github.com/QwenLM/Qwen3-Coder", 2)]
