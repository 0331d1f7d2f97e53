import random

from pyspark.sql import functions as F

from cardloom.operators import occurrences as O


def _found(spark, texts, names, **how):
    t = spark.createDataFrame(texts, "target string, id int, text string, hits int").drop("hits") if not how.pop("clash", False) else spark.createDataFrame(texts, "target string, id int, text string, row int")
    n = spark.createDataFrame(names, "target string, name string, id string, type string")
    return {r.id: [tuple(h) for h in r.hits] for r in O.with_names(t, n, **how).collect()}


def test_a_name_inside_a_longer_one_counts_only_where_it_stands_alone(spark):
    names = [("a", "nova", "n", "x"), ("a", "nova 3", "n3", "x"), ("a", "nova", "n", "x"), ("a", "3", "three", None), ("a", "", "e", "x"), ("a", None, "e", "x"), ("b", "zeta", "z", "x"), (None, "t", "t", "t")]
    texts = [("a", 1, "nova 3 and nova", 0), ("a", 2, "nova 3", 0), ("a", 3, None, 0), ("a", 4, "", 0), ("b", 5, "nova zeta", 0), ("c", 6, "nova", 0), (None, 7, "t", 0), ("a", 8, "😀nova", 0), ("a", 2, "nova 3", 0)]
    want = {1: [(0, 6, "n3", "x"), (11, 4, "n", "x")], 2: [(0, 6, "n3", "x")], 3: [], 4: [], 5: [(5, 4, "z", "x")], 6: [], 7: [], 8: [(1, 4, "n", "x")]}
    assert _found(spark, texts, names) == want
    assert _found(spark, texts, names, slices=1, clash=True) == want
    assert _found(spark, texts, names, longest=False)[2] == [(0, 4, "n", "x"), (0, 6, "n3", "x"), (5, 1, "three", None)]
    assert _found(spark, [], names) == {} and _found(spark, texts[:1], []) == {1: []}


def test_same_as_search_of_each_name(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("ab ") for _ in range(n))
    names = [("t", w, w, "x") for w in sorted({word(rnd.randint(1, 4)) for _ in range(60)})]
    texts = [("t", i, word(rnd.randint(0, 60)), 0) for i in range(80)]
    got = _found(spark, texts, names, longest=False, slices=3)
    for _, i, text, _ in texts:
        assert sorted((h[0], h[2]) for h in got[i]) == sorted((text.find(n[1]), n[1]) for n in names if n[1] in text)


def test_hot_target_streams(spark):
    texts = spark.range(30000).select(F.lit("t").alias("target"), "id", F.concat(F.lit("x nova-"), F.col("id").cast("string")).alias("text"))
    names = spark.range(3000).select(F.lit("t").alias("target"), F.concat(F.lit("nova-"), F.col("id").cast("string")).alias("name"), F.col("id").cast("string").alias("id"), F.lit("m").alias("type"))
    got = O.with_names(texts, names, slices=4).select("id", F.get("hits", F.lit(0))["n"].alias("n"), F.size("hits").alias("k"))
    assert got.where("k = 1").count() == 30000 and got.where("id < 3000 and n <> length(cast(id as string)) + 5").count() == 0


def test_line_owners(spark):
    targets = spark.createDataFrame([("t", "org/Nova-3-8B", ["finetune:org/Nova-3", "bare", None, "org/Nova-3-8B"]), ("u", "solo", None)], "target string, model string, bases array<string>")
    rows = [("t", "Nova-3-8B scores 3", "base"), ("t", "org/Nova-3-8B scores", "base"), ("t", "see 3 of org/Nova-3-8B", "base"), ("t", "x Nova-3 then Nova-3-8B", "base"), ("t", "Zeta-7 then org/Nova-3", "base"), ("t", "Zeta-7 wins", "other"), ("t", "nova-3-8b wins", None), ("t", "well-known words", None), ("t", "", None), ("t", None, None), ("u", "solo-7", "target"), ("u", "Zeta-7 solo", "target"), ("v", "Zeta-7", "other"), ("v", "plain", None)]
    lines = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, target string, text string, want string")
    got = O.line_owners(lines, targets).orderBy("i").collect()
    assert [(r.text, r.owner) for r in got] == [(r[1], r[2]) for r in rows]


def test_telling_tokens(spark):
    df = spark.createDataFrame([("Trained on 1,024 GPUs, 7 days, OLMo-2 and H100 with float, 15.2 and 1,024",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(O.telling_tokens(F.col("v"))).collect()]
    assert got == [["1,024", "100", "15.2", "GPUs", "OLMo-2", "H100"], [], None]
