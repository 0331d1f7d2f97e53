"""Columns of clashing names, and what the pipeline's stages do with nulls, empties, ties, repeats and empty tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from cardloom.llm import language, mixing, pieces, quality
from cardloom.llm.common import lowest, table

SF = "/root/testdata/sf0.001"
CLASH = "row version _version of of_doc _copy _copies copies _key ids _words q lang_pred score predicted evidence gone removed n_lines toxic key fp stays key_ text_ id".split()


def clashing(docs, *rows):
    return docs(*rows).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in CLASH})


def test_columns_that_clash_come_back(docs):
    df = clashing(docs, (1, "one two three"), (2, None), (3, "der die das"))
    for out, replaced in ((mixing.mixed(df), ()), (pieces.encode(df), ("ids",)), (language.identify(df, docs((1, "one two", "en"), (3, "der die", "de"))), ("lang_pred", "score"))):
        assert set(out.columns) >= set(CLASH)
        for r in out.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in CLASH if n not in replaced)
    assert quality.line_quality(df).columns[0] == "doc_id"


def test_stages_keep_columns_and_take_edges(spark, docs):
    long = "a sentence of some words, again and again. " * 3000
    df = clashing(docs, (1, None), (2, ""), (3, " \n\t"), (4, "one line\nand one more"), (4, "one line\nand one more"), (5, "one line\nits own"), (None, "one line"), (6, long), (7, long + "end"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        got = out.collect()
        assert {r.doc_id for r in got} <= {r.doc_id for r in df.collect()}
        assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got for n in CLASH)
        empty = stage(spark, df.where("doc_id > 99"), SF)
        assert empty.columns == df.columns and empty.collect() == []
    kept = corpus_pipeline.drop_repeated_lines(spark, df, SF)
    assert {(r.doc_id, r.text, r.n_chars) for r in kept.where("doc_id in (1, 2, 5)").collect()} == {(1, None, None), (2, "", 0), (5, "its own", 7)}
    alone = corpus_pipeline.drop_near_copies(spark, df, SF)
    assert sorted(str(r.doc_id) for r in alone.collect()) == ["1", "4", "5", "6", "None"]
    assert len(corpus_pipeline.mix(spark, df, SF).where("doc_id in (1, 2, 3)").collect()) == 0
    last = corpus_pipeline.tokenize(spark, df, SF).collect()
    assert len(last) == 9 and [r.ids for r in last if r.doc_id == 1] == [None] and [r.ids for r in last if r.doc_id == 2] == [[]]


def test_language_takes_ties_long_texts_and_every_language(docs):
    train = docs(*[(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)} text", f"l{i:03d}") for i in range(300)])
    long = " ".join(f"{a}{b}{c}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "aeiou" for c in "bcdfghjklmnpqrstvwxz") * 40
    asked = docs((1, "wordba text"), (2, long), (3, long))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(asked, train).collect()}
    assert got[2] == got[3] and all(x[0].startswith("l") for x in got.values())
    model = language.fit(train)
    assert len(model.languages) == 300
    same = language.Model(language.presence(["x y", "x y"]), ["b", "a"], __import__("numpy").array([0, 1]), 1e-3)
    assert same.predict(language.presence(["x y"]))[0] == ["a"]


def test_language_kernel_equals_a_plain_one():
    texts = ["The cat", "der Hund und", "cat cat", "日本語"]

    def grams(t):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        return {s[i : i + n] for n in range(1, 5) for i in range(len(s) - n + 1)}

    rows = language.presence(texts, 1 << 20)
    common = rows.astype(int) @ rows.T.astype(int)
    assert [[len(grams(a) & grams(b)) for b in texts] for a in texts] == common.tolist()


def test_lowest_in_two_levels(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id")
    got = {(r.g, r.id) for r in lowest(df, ["g"], [F.col("id")], 4).collect()}
    assert got == {(i % 3, i) for i in range(12)}


def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    want = sorted((r.doc_id, len(r.ids)) for r in corpus_pipeline.tokenize(spark, docs, SF).collect())
    assert sorted((r.doc_id, len(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()) == want
