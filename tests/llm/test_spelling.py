"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from cardloom.llm.spelling import near_words, spelling_variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    forms, near = {}, {}
    for w, n in words.items():
        found = sorted(((-m, v) for v, m in words.items() if one_edit(w, v)))
        near[w] = len(found)
        forms[w] = found[0][1] if found and -found[0][0] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, near[w], forms[w], words.get(forms[w]), root))
    return sorted(out)


def test_documents_against_all_pairs(docs):
    rng = random.Random(3)
    base = ["".join(rng.choice("abÀéß÷z") for _ in range(rng.randint(6, 20))) for _ in range(25)] + ["Interesting", "ÜBERALLHIN", "a" * 9, "q" * 70, "w" * 300]
    text = []
    for w in base:
        for n in (1500, 110, 3, 2):
            i, v = rng.randrange(len(w)), w
            if n < 1500:
                v = rng.choice([w[:i] + w[i + 1 :], w[:i] + "é" + w[i:], w[:i] + "k" + w[i + 1 :]])
            text += [v] * rng.choice([n, n // 2 + 1])
    rng.shuffle(text)
    rows = [(i, rng.choice([" ", "\n", "-", "1"]).join(text[i::40])) for i in range(40)]
    rows += [(40, None), (41, ""), (None, " ".join(base)), (7, rows[7][1]), (7, rows[7][1])]
    got = spelling_variants(docs(*rows)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)
    assert any(r["root"] != (r["form"] or r["word"]) for r in got)


def test_short_open_parts_lose_no_pair(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(7, 11))) for _ in range(400)} | {"a" * n for n in range(1, 40)})
    got = near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), open_letters=3).select("word", "other").collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_no_words(docs):
    assert spelling_variants(docs((1, None), (2, "short words"))).collect() == []
    assert spelling_variants(docs((1, "x")).where("doc_id < 0")).collect() == []
