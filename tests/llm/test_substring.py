import hashlib
import random

from cardloom.llm.substring import substring_dedup


def plain(rows, window):
    """By trying every window of every document against all documents with smaller ids."""
    words = [(i, (x or "").encode().split()) for i, x in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_against_every_window(docs):
    rnd = random.Random(3)
    word = lambda: rnd.choice("ab cd ef gh ij kl mn op".split())
    base = [[word() for _ in range(rnd.randint(0, 90))] for _ in range(12)]
    rows = []
    for i in range(60):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            if w:
                w[rnd.randrange(len(w))] = word()
        at = rnd.randint(0, len(w))
        rows.append((i, " ".join(w[at:] + rnd.choice(base)[:40] + w[:at])))
    rows += [(100, None), (101, ""), (102, " \t\n "), (103, "x " * 3000), (104, "x " * 2000), (104, "x " * 2000), (None, rows[5][1]), (105, " ".join("abcdef") + " é " * 30)]
    got = sorted(map(tuple, substring_dedup(docs(*rows), window=10, seed=4, with_text=False).collect()), key=str)
    assert got == plain(rows, 10)


def test_no_rows(docs):
    assert substring_dedup(docs((1, "a")).where("doc_id > 5")).collect() == []


def test_kept_text(docs):
    same = " ".join(f"w{i}" for i in range(60))
    got = {r.doc_id: r.kept_text for r in substring_dedup(docs((1, same), (2, "new " + same + " end"))).collect()}
    assert got == {1: same, 2: "new end"}


def test_factors_run_on_over_blocks_and_name_their_source(docs):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, "x y " + " ".join(words[50:250]) + " z " + " ".join(words[300:370]))]
    got = {r.doc_id: [tuple(x) for x in r.factors] for r in substring_dedup(docs(*rows)).collect()}
    assert got == {1: [], 2: [(2, 200, 1, 50), (203, 70, 1, 300)]}


def test_words_that_a_polynomial_hash_confuses_stay(docs):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    assert a != b and len(a) == 1024
    rest = " ".join(f"v{i}" for i in range(49))
    got = {r.doc_id: r.n_removed for r in substring_dedup(docs((1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}"))).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


def test_a_factor_whose_words_differ_from_its_source_is_none(docs, monkeypatch):
    # even where all windows hash alike
    import numpy as np

    from cardloom.llm import substring

    monkeypatch.setattr(substring, "word_hashes", lambda data, s, e: np.ones(len(s), np.uint64))
    rows = [(1, " ".join(f"a{i}" for i in range(60))), (2, " ".join(f"b{i}" for i in range(60)))]
    assert [r.n_removed for r in substring_dedup(docs(*rows)).collect()] == [0, 0]


def test_columns_that_clash_are_not_read(spark):
    df = spark.createDataFrame([(1, "a b", 1, 2, 3, 4)], "doc_id long, text string, version int, anchor int, factors int, digest int")
    assert [(r.doc_id, r.n_words) for r in substring_dedup(df).collect()] == [(1, 2)]
