"""Toxicity and language: exactness of the search, edges, and accuracy on held-out rows."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cardloom.llm import language, toxicity
from cardloom.llm.common import table
from cardloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_terms(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return Counter(words + [w[:5] + "*" for w in words if len(w) > 5])


def test_terms_are_letter_runs_and_beginnings():
    for text in ("A cat, the CAT; concatenated concat 12x3 x_y", "", "12 -", "Ünïcode ÜNÏCODE 日本語の文章です ß", "a" * 3000):
        f, n = toxicity.term_counts(text)
        assert sorted(n.tolist()) == sorted(plain_terms(text).values())
    assert set(toxicity.term_counts("abcdef")[0]) & set(toxicity.term_counts("abcdexyz")[0])
    assert not set(toxicity.term_counts("abcde")[0]) & set(toxicity.term_counts("abcdef")[0])


def test_block_max_search_equals_cosines_of_whole_texts():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 40))) for _ in range(700)]
    known = sorted({t for x in texts for t in plain_terms(x)})
    of = lambda t: set(toxicity.term_counts(t)[0].tolist())
    code = {t: (of(t[:-1] + "q") & of(t[:-1] + "w")).pop() for t in known if t[-1] == "*"}
    code |= {t: (of(t) - {code.get(t[:5] + "*")}).pop() for t in known if t[-1] != "*"}
    weight = {t: rnd.random() + 0.05 for t in known}
    order = sorted(known, key=code.get)
    space = toxicity.Space(np.array([code[t] for t in order], np.int64), np.array([*(weight[t] for t in order), 0.5]))

    def dense(text):
        counts = plain_terms(text)
        w = {t: (1 + np.log(n)) * weight.get(t, 0.5) for t, n in counts.items()}
        length = np.sqrt(sum(x * x for x in w.values()))
        return np.array([w.get(t, 0) / length for t in known])

    index = toxicity.Index(len(known), [(i, i % 2, *space.vector(*toxicity.term_counts(x))) for i, x in enumerate(texts)])
    assert len(index.matrix) and len(index.at)
    matrix = np.array([dense(texts[i]) for i in index.ids])
    for _ in range(60):
        text = " ".join(rnd.choices(words, k=rnd.randint(1, 30)) + ["never", "seen before"] * rnd.randint(0, 1))
        cosines = matrix @ dense(text)
        found, score = index.nearest([space.vector(*toxicity.term_counts(text))], 15)[0]
        assert np.allclose(score, np.sort(cosines)[::-1][: len(score)]) and np.allclose(cosines[found], score)
        assert len(found) == min(15, (cosines > 1e-15).sum())


def test_texts_of_few_postings_need_no_bounds(monkeypatch):
    rnd = np.random.default_rng(3)
    some = lambda n: (np.sort(rnd.choice(400, n, replace=False)), rnd.random(n))
    index = toxicity.Index(400, [(i, i % 2, *some(rnd.integers(1, 60))) for i in range(900)])
    asked = [some(n) for n in (1, 5, 40, 200)]
    without = [[], [3], [0, 899], []]
    direct = index.nearest(asked, 15, without)
    monkeypatch.setattr(toxicity, "DIRECT", 0)
    for (found, score), (other, bounded) in zip(direct, index.nearest(asked, 15, without), strict=True):
        assert found.tolist() == other.tolist() and score.tolist() == bounded.tolist()


def test_signs_looked_up_have_the_hashes_of_others(monkeypatch):
    text = "Straße " + "a" * 31 + " b"
    looked_up = toxicity.term_counts(text)[0].tolist()
    assert set(looked_up) < set(toxicity.term_counts(text + " 日本 " + "a" * 40)[0].tolist())
    monkeypatch.setattr(toxicity, "_PLACES", 0)
    assert toxicity.term_counts(text)[0].tolist() == looked_up


def test_all_terms_count_in_a_cosine(docs, spark):
    long = "vile " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(5000))
    rows = [(i, "a vile thing" if i % 2 else "a fine thing") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    near = toxicity.score_toxicity(docs((1, long)), docs(*rows), labels).first().evidence
    assert near and near[0].cosine < 0.7


def test_toxicity_edges(spark, docs):
    bad, good = "what a vile nasty thing to say", "what a kind sunny thing to say"
    rnd = random.Random(1)
    other = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(6))
    rows = [(i, (bad if i % 3 == 0 else good) + "".join(f" {other()}" for _ in range(30))) for i in range(150)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    asked = docs(*rows, (500, None), (501, ""), (502, "vile " * 40_000), (502, "vile " * 40_000), (None, "sunny day"))
    got = {(r.doc_id, r.predicted): r.score for r in toxicity.score_toxicity(asked.select("doc_id", "text"), docs(*rows), labels).collect()}
    assert (502, 1) in got and (None, 0) in got and 0 <= min(got.values()) <= max(got.values()) <= 1
    assert all((i, int(i % 3 == 0)) in got for i in range(150))
    assert got[500, 0] == got[501, 0]
    clash = asked.where("doc_id = 502").withColumns({"score": F.lit("x"), "row": F.lit("y"), "toxic": F.lit("z"), "f": F.lit("w")})
    out = toxicity.score_toxicity(clash, docs(*rows), labels)
    assert out.columns == [*clash.columns, "predicted", "evidence"] and [(r.predicted, r.row, r.toxic, r.f) for r in out.collect()] == [(1, "y", "z", "w")] * 2
    assert toxicity.clean(clash, docs(*rows), labels).columns == clash.columns
    one = labels.where("toxic = 0")
    assert {r.score for r in toxicity.score_toxicity(asked, docs(*rows), one).collect()} == {0.0}
    assert toxicity.score_toxicity(asked.select("doc_id", "text").where("doc_id > 900"), docs(*rows), labels).collect() == []


def test_toxicity_held_out_accuracy(spark):
    met = QUERIES["op6_toxicity"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out")
    right, n, clean_wrong = met.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*"), F.count_if((F.col("toxic") == 0) & (F.col("predicted") == 1))).first()
    assert right / n >= 0.95 and clean_wrong / n <= 0.03


def test_language_edges_and_accuracy(spark, docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog ran home", "en"), ("der hund und die katze laufen", "de")] * 20)]
    train = docs(*rows, (90, "no language", None), (91, None, "fr"), (92, "123 456", "es"))
    asked = docs((1, None), (2, ""), (3, "12 34 !"), (4, "the dog and the cat"), (4, "the dog and the cat"), (None, "die katze und der hund"), (5, "the cat " * 50_000)).select("doc_id", "text")
    got = {(r.doc_id, r.lang_pred) for r in language.identify(asked, train).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de"), (5, "en")}
    assert {r.lang_pred for r in language.identify(asked, train.where("doc_id > 900")).collect()} == {"und"}
    assert language.identify(asked.where("doc_id > 900"), train).collect() == []
    met = QUERIES["op10_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    assert met.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


def plain_grams(text):
    letters = "".join(c if "a" <= c <= "z" or ord(c) >= 0xC0 else " " for c in text.lower())
    return {letters[i : i + n] for n in range(1, 5) for i in range(len(letters) - n + 1)}


def test_predictions_equal_dense_kernel_ridge(spark, docs):
    """With all examples as landmarks the map is exact, so the dual form over sets of grams must give the same margins; in a million bins few grams of these texts collide."""
    rnd = random.Random(8)
    kinds = {"aa": "the with that from have", "bb": "und der nicht über straße", "cc": "les dans être où avec"}
    known = [(i, " ".join(rnd.choice(kinds[k].split() + ["x1", "data", "42,"]) for _ in range(9)), k) for i, k in enumerate(sorted(kinds) * 7)]
    asked = [(100 + i, " ".join(rnd.choice(" ".join(kinds.values()).split()) for _ in range(6)), None) for i in range(30)]
    train = docs(*known)
    train = train.unionByName(train)  # repeated rows teach once
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs(*asked), train, bits=1 << 20).collect()}
    grams, labels = [plain_grams(t) for _, t, _ in known], sorted(kinds)
    like = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    k = np.array([[like(a, b) for b in grams] for a in grams])
    n = len(known)
    center = np.eye(n) - 1 / n
    y = np.array([[1.0 if lang == x else -1.0 for x in labels] for _, _, lang in known])
    dual = np.linalg.solve(center @ k @ center + language.RIDGE * n * np.eye(n), y - y.mean(axis=0))
    for i, text, _ in asked:
        row = np.array([like(plain_grams(text), g) for g in grams])
        margin = (row - k.mean(axis=0)) @ center @ dual + y.mean(axis=0)
        e = np.exp(4 * (margin - margin.max()))
        assert got[i][0] == labels[int(margin.argmax())] and abs(got[i][1] - e.max() / e.sum()) < 1e-3
