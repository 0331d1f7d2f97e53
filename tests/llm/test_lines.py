import random

import numpy as np

from cardloom.llm import lines
from cardloom.llm.lines import Lines, Sets, dedup_lines
from cardloom.llm.neardup import Texts


def split_lines(text):
    return [(n, y) for n, x in enumerate(text.split("\n")) if (y := x.strip(" \t\x0b\f\r"))]


def shingles(line, shingle=5):
    return {line[i : i + shingle] for i in range(max(1, len(line) - shingle + 1))}


def plain(rows, least=0.8):
    """Every pair of distinct lines."""
    places = [((i is None, i or 0, n), x) for i, t in rows for n, x in split_lines(t or "")]
    first = {}
    for p, x in sorted(places):
        first.setdefault(x, p)
    lines = list(first)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {x: shingles(x) for x in lines}
    for k, x in enumerate(lines):
        for y in lines[:k]:
            common = len(sets[x] & sets[y])
            if common >= least * (len(sets[x]) + len(sets[y]) - common):
                a, b = find(x), find(y)
                if a != b:
                    parent[max(a, b, key=first.get)] = min(a, b, key=first.get)
    return {p: first[find(x)] for p, x in places if first[find(x)] != p}


def test_against_every_pair(docs):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    base = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(120):
        out = []
        for _ in range(3):
            w = rnd.choice(base).split()
            for _ in range(rnd.choice([0, 1, 2, 3, 5])):
                w[rnd.randrange(len(w))] = word()
            out.append("  " + " ".join(w) if rnd.random() < 0.8 else word())
        rows.append((i, "\n".join(out)))
    rows += [(200, None), (201, ""), (202, " \n\n"), (203, "short\nshort\n\nshort "), (None, base[0])]
    got = {}
    for r in dedup_lines(docs(*rows)).collect():
        for x in r.removed:
            got[(r.doc_id is None, r.doc_id or 0, x.line)] = (x.as_doc is None, x.as_doc or 0, x.as_line)
    want = plain(rows)
    missed = [p for p in want if got.get(p) != want[p]]
    assert set(got) <= set(want) and len(missed) <= len(want) // 50


def test_edges(docs):
    rows = [(1, "one line of text\nanother line"), (2, "one line of text\nits own line"), (3, None), (4, ""), (5, "one line of text"), (5, "one line of text"), (6, "z" * 200_000 + "\n" + "z" * 200_000)]
    out = dedup_lines(docs(*rows))
    assert out.columns == [*docs(*rows).columns, "n_lines", "removed"]
    got = sorted((r.doc_id, r.text, r.n_lines, len(r.removed)) for r in out.collect() if r.text is not None)
    assert got == [(1, rows[0][1], 2, 0), (2, "its own line", 2, 1), (4, "", 0, 0), (5, "", 1, 1), (5, "", 1, 1), (6, "z" * 200_000, 2, 1)]
    assert out.where("doc_id = 3").first().text is None
    assert dedup_lines(docs(*rows).where("doc_id > 99")).collect() == []


def test_one_character_edits_of_short_lines_are_linked(docs):
    rnd = random.Random(8)
    rows = []
    for i in range(100):
        line = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randint(60, 76)))
        line = f"a{line[1:-1]}z"
        at = len(line) // 2
        rows += [(2 * i, line), (2 * i + 1, f"{line[:at]}7{line[at + 1 :]}")]
    removed = {r.doc_id: [x.as_doc for x in r.removed] for r in dedup_lines(docs(*rows)).collect()}
    assert not any(removed[2 * i] for i in range(100))
    assert sum(removed[2 * i + 1] == [2 * i] for i in range(100)) >= 98


def test_a_cell_meets_every_pair_alike(docs):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(120)) for _ in range(4)]
    lines = []
    for _ in range(300):
        x = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 4, 8])):
            x[rnd.randrange(len(x))] = rnd.choice("xyz")
        lines.append("".join(x))
    lines += ["a", "ab", "abcde", "abcdef"]
    n = len(lines)
    cell = np.r_[np.repeat(0, 200), np.repeat(1, n - 208), np.repeat(2, 8)]
    other = np.r_[np.arange(200) >= 90, np.arange(n - 208) >= 40, np.arange(8) >= 3]
    sets, kind = Sets(lines, Lines()), np.arange(n)
    p, o = sets.candidates(cell, other, kind, 0.8)
    found = {(int(a), int(b)) for a, b, hit in zip(p, o, sets.alike(p, o, 0.8), strict=True) if hit}
    alike = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    want = {(a, b) for a in range(n) for b in range(n) if not other[a] and other[b] and cell[a] == cell[b] and alike(shingles(lines[a]), shingles(lines[b]))}
    assert found == want and len(want) > 300


def test_a_bucket_of_many_components_loses_no_link(spark, docs):
    # lines of one template that differ enough to be no copies of each other, with a near copy for each: all share many bands
    rnd = random.Random(13)
    head = "the common beginning of each of these lines is just as long as what follows it here and "
    rows = []
    for i in range(400):
        tail = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80))
        rows += [(2 * i, head + tail), (2 * i + 1, head + tail[:-1] + "7")]
    removed = {r.doc_id: [x.as_doc for x in r.removed] for r in dedup_lines(docs(*rows).repartition(5)).collect()}
    assert sum(removed[2 * i + 1] == [2 * i] for i in range(400)) >= 396
    assert not any(removed[2 * i] for i in range(400))


def test_columns_that_clash_come_back(spark):
    names = ["doc_id", "text", "_version", "version", "key", "row", "gone", "of_doc", "of", "id", "removed"]
    df = spark.createDataFrame([(i, "same line\nline of its own", *(f"{n}{i}" for n in names[2:])) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    out = dedup_lines(df)
    assert out.columns == [*names, "n_lines"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i][n] == f"{n}{i}" for i in range(3) for n in names[2:-1])
    assert [len(got[i].removed) for i in range(3)] == [0, 2, 2]


def test_common_shingles_are_counted_exactly():
    rnd = random.Random(3)
    for signs in ("abc ", "абв ", "日本語テ", "a\U0001f600é"):
        for n in (3, 5, 60):
            x, y = ("".join(rnd.choice(signs) for _ in range(n + k)) for k in (0, 2))
            assert Lines().in_common(x, y) == (len(shingles(x) & shingles(y)), len(shingles(x) | shingles(y)))
    assert Texts().in_common("a b c d e f", "a b c d e g") == (1, 3)


def test_marks_differ_in_no_more_bits_than_sets_in_shingles():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (1, 4, 5, 30, 200, 900)]
    texts += [t[:k] + "x" + t[k + 1 :] for t in texts for k in (0, len(t) // 2)] + ["é" * 40, "é" * 39 + "日"]
    mark = Sets(texts, Lines()).marks()
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            common, together = Lines().in_common(x.ljust(5, "\0"), y.ljust(5, "\0"))
            bits = int(np.bitwise_count(mark[i] ^ mark[j]).sum())
            assert bits <= together - common
            assert common < 0.8 * together or bits <= lines.most_apart(common + together, 0.8)
    assert np.bitwise_count(mark[4] ^ mark[5]).sum() > lines.most_apart(200 + 900, 0.8) / 4


def test_lines_apart_by_their_marks_are_not_looked_at(monkeypatch):
    texts = ["the quick brown fox jumps over", "the quick brown fox jumps over!", "nothing of this is the same text", "the quick brown fox jumped over a dog"]
    sets = Sets(texts, Lines())
    cell, other, kind = np.zeros(4, np.int64), np.array([False, True, True, True]), np.arange(4)
    for most in (256, 0):
        monkeypatch.setattr(lines, "_MOST_BY_MARKS", most)
        near = lines._near_by_marks(cell, other, kind, sets.size, sets.marks(), 0.8)
        assert near.tolist() == ([True, True, False, False] if most else [True] * 4)


def test_a_stage_of_pairs_has_one_python_step(spark):
    texts = spark.createDataFrame([(i, "the same line of text, number " + str(i)) for i in range(6)], "id long, text string")
    marked = lines.cut(lines._marked(texts, Lines()), "texts")
    found = lines._verified(spark.createDataFrame([(1, 0), (2, 0), (3, 2)], "a long, b long"), marked, 0.8, Lines())
    again = lines.components(found)
    assert {(r.id, r.component) for r in again.collect()} == {(0, 0), (1, 0), (2, 0), (3, 0)}
    assert "MapInArrow" not in found._jdf.queryExecution().toString()


def test_a_small_bucket_gives_all_its_pairs_and_a_large_one_a_star(spark):
    texts = [(i, "one line of text that many hold alike" if i < 40 else f"another line {'abc'[i % 3]} that few hold" * 3) for i in range(46)]
    found = lines._buckets(spark.createDataFrame(texts, "id long, text string").repartition(3), 16, 5, Lines()).collect()
    large = [(r.id, r.first) for r in found if r.bucket is not None]
    assert {i for r in large for i in r} == set(range(40)) and len(large) == 16 * 39
    small = {(r.id, r.first) for r in found if r.bucket is None}
    assert {(43, 40), (44, 41), (45, 42)} <= small and all(40 <= b < a for a, b in small)


def test_numbers_of_shingles_say_what_shingles_say():
    rnd = random.Random(4)
    texts = ["ab", "ab\0\0\0", "abcd", "\0\0\0\0\0", "abcde"]
    for signs in ("ab ", "abcdefgh é", "日本語テ\U0001f600"):
        texts += ["".join(rnd.choice(signs) for _ in range(rnd.randint(5, 80))) for _ in range(20)]
    texts += [t + "x" for t in texts] + [t[:-1] for t in texts if len(t) > 5]
    many = "".join(chr(0x4E00 + i) for i in range(2000))
    pairs = np.array([(i, j) for i in range(len(texts)) for j in range(len(texts))])
    for more, apart in ([], True), ([many], False):
        sets = Sets(texts + more, Lines(), alone=True)
        assert sets.told_apart == apart
        assert sets.size[:5].tolist() == [1, 1, 1, 1, 1]
        alike = [len(a & b) >= 0.8 * len(a | b) for a, b in ((shingles(texts[i]), shingles(texts[j])) for i, j in pairs)]
        assert sets.alike(pairs[:, 0], pairs[:, 1], 0.8).tolist() == alike


def test_lines_differ_in_no_more_shingles_than_stand_between_common_ends():
    rnd = random.Random(6)
    sure = 0
    for of, signs, gap in ((Lines(), "ab \u00e9", ""), (Lines(), "abcdefgh", ""), (Texts(), "abc", " ")):
        for n in (1, 4, 5, 6, 40, 300):
            for _ in range(30):
                x = [rnd.choice(signs) for _ in range(n)]
                y = list(x)
                for _ in range(rnd.choice([1, 1, 2])):
                    at = rnd.randrange(len(y) + 1)
                    y[at : at + rnd.randint(0, 2)] = [rnd.choice(signs + "7") for _ in range(rnd.randint(0, 3))]
                x, y = gap.join(x), gap.join(y)
                common, together = of.in_common(x.ljust(5, "\0"), y.ljust(5, "\0")) if not gap else of.in_common(x, y)
                assert together - common <= lines._apart(x, y, of)
                if lines._apart(x, y, of) + 1 <= lines.most_apart(common + together, 0.8):
                    assert common >= 0.8 * together
                    sure += 1
    assert sure > 50
    assert lines._apart("one line of words", "one line of swords", Lines()) == 4 + 5
    common, together = Texts().in_common("a b c d e foo bar", "a b c d e foobar")
    assert together - common <= lines._apart("a b c d e foo bar", "a b c d e foobar", Texts())


def test_equal_buckets_stand_together_in_their_order():
    rng = np.random.default_rng(2)
    for top in (4, 1 << 20, (1 << 64) - 1):
        bucket = rng.integers(0, top, 5000, np.uint64, endpoint=True)
        assert lines._together(bucket).tolist() == np.argsort(bucket, kind="stable").tolist()
        assert lines._together(bucket.view(np.int64)).tolist() == np.argsort(bucket, kind="stable").tolist()


def test_bits_of_marks_are_added_up():
    rng = np.random.default_rng(7)
    mark = np.r_[rng.integers(0, (1 << 64) - 1, (6, 8), np.uint64, endpoint=True), np.zeros((1, 8), np.uint64), np.full((1, 8), (1 << 64) - 1, np.uint64)]
    p, o = np.repeat(np.arange(8), 8), np.tile(np.arange(8), 8)
    apart = np.bitwise_count(mark[p] ^ mark[o]).sum(axis=1)
    for n in (0, 255, 256, 511, 512):
        size = np.full(8, (n + 0.5) * 9 / 2)
        assert (lines._alike_by_marks(p, o, size, mark, 0.8) == (apart <= n)).all()


def test_only_lines_that_meet_others_are_sent(spark):
    near = "one line of text that stands in two documents but for a sign"
    texts = [f"{near}.\na line that no other is like", f"{near}!\nequal lines", "equal lines\nequal lines\nthird of its kind", None, ""]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, version long, text string").repartition(2)
    buckets = lines.cut(lines._buckets(docs, 16, 5, Lines(), 0), "buckets")
    met = spark.sparkContext.broadcast(lines._bits(buckets))
    sent = lines._places(docs, Lines(), 0, met).collect()
    assert sorted((r.doc_id, r.line) for r in sent) == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1)]
    assert {r.text for r in sent if r.text is not None} == {f"{near}.", f"{near}!"}
    assert sum(r.n or 0 for r in sent) == 5


def test_lines_of_one_number_are_told_apart(spark, monkeypatch):
    class Crowded(Lines):
        def ids(self, lines, salt):
            number, rest = super().ids(lines, salt)
            return (number if salt else number & 1), rest

    texts = [f"line {i % 7} of text that few documents hold, number {i % 7} {'abcdefg'[i % 7] * 9}\nits own {i} " + chr(97 + i) * 30 for i in range(20)]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, version long, text string")
    want = sorted(lines.line_components(docs).collect())
    assert [(r.doc_id, r.line, r.as_doc) for r in want] == [(i, 0, i % 7) for i in range(7, 20)]
    assert sorted(lines.line_components(docs, of=Crowded()).collect()) == want
    monkeypatch.setattr(lines, "_MOST_BITS", 6)  # nearly all lines share their bit with others
    assert sorted(lines.line_components(docs).collect()) == want


def test_a_pair_that_comes_in_many_bands_is_compared_once(spark):
    texts = lines.cut(lines._marked(spark.createDataFrame([(i, f"the same line of text, number {i}") for i in range(2)], "id long, text string"), Lines()), "texts")
    found = lines._verified(spark.createDataFrame([(1, 0)] * 50, "a long, b long"), texts, 0.8, Lines())
    assert [(r.a, r.b) for r in found.collect()] == [(1, 0)]
