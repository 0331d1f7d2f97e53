"""Byte dedup by sorted suffixes against a table of all strings."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from cardloom.llm import suffixes
from cardloom.llm.suffixes import repeated_bytes


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(rng.choice([20, 40, 60, 200])) for _ in range(6)]
    rows = []
    for i in range(70):
        text = say(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            text += " " + p[a : len(p) - rng.randrange(len(p) // 3)] + " " + say(rng.randint(0, 30))
        if rng.random() < 0.3:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice("xyz") + text[at:]
        rows.append((i, text))
    near = say(600)
    for i in range(12):  # copies with edits of their own
        at = [rng.randrange(len(near)) for _ in range(4)]
        rows.append((100 + i, "".join("X" if p in at else c for p, c in enumerate(near))))
    rows += [(200, near), (201, near), (201, near), (None, near[50:900]), (202, None), (203, ""), (204, "a" * 199), (205, "b" * 199), (206, "c" * 900), (207, "ab" * 350 + say(40))]
    rows += [(208, passages[3] + passages[3]), (209, "z" * 260 + "c" * 230), (210, "".join(rng.choice("01") for _ in range(1500)) * 2)]
    rows += [(300 + i, say(6) + near[400:640] + say(5)) for i in range(40)]
    return rows


@pytest.mark.parametrize("length,stretch", [(200, 1 << 15), (120, 64)])
def test_against_all_strings(spark, docs, monkeypatch, length, stretch):
    monkeypatch.setattr(suffixes, "STRETCH", stretch)
    rows = made(length)
    run = suffixes._neighbours
    monkeypatch.setattr(suffixes, "_neighbours", lambda n: _small(run(n), stretch))
    got = repeated_bytes(docs(*rows), length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans").collect()
    want = plain(rows, length)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    assert any(r[2] for r in want) and any(0 < r[2] < r[1] for r in want)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def _small(run, rows):
    """Has run see few rows at once, so that repeats lie on both sides of a stretch's edge."""

    def cut_up(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                yield from run(iter([batch.slice(i, rows)]))

    return cut_up


def test_no_rows_and_no_repeats(docs):
    assert repeated_bytes(docs((1, "x")).where("doc_id < 0")).collect() == []
    assert [tuple(r)[:4] for r in repeated_bytes(docs((1, "x" * 150)), with_text=False).collect()] == [(1, 150, 0, 0)]
    with pytest.raises(ValueError):
        repeated_bytes(docs((1, "x")), 50)


@pytest.mark.parametrize("together", [1, 1 << 18])
def test_anchors_that_repeat_in_one_task_or_several(docs, monkeypatch, together):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    rows = made(5)
    texts = docs(*rows).where("text is not null").selectExpr("doc_id * 1 as id", "xxhash64(text) as k", "text")
    by_key = {r.k: r.text.encode() for r in texts.collect()}
    count = Counter()
    for _, t in rows:
        t = (t or "").encode()
        data = suffixes.np.frombuffer(t, suffixes.np.uint8)
        a = suffixes.Anchors(data, suffixes.np.array([0, len(data)]), 200)
        count.update(t[at : at + 105] for at in a.at.tolist())
    for n in (1, 7):
        found = {r.k: [(x.low, x.high) for x in r.ranges] for r in suffixes.repeated_anchors(texts.select("k", "text").repartition(n)).collect()}
        expected = {}
        for k, t in by_key.items():
            a = suffixes.Anchors(suffixes.np.frombuffer(t, suffixes.np.uint8), suffixes.np.array([0, len(t)]), 200)
            again = [(lo, hi) for at, lo, hi in zip(a.at.tolist(), a.low.tolist(), a.high.tolist(), strict=True) if count[t[at : at + 105]] > 1]
            expected |= {k: again} if again else {}
        assert found == expected


def test_rows_of_runs_come_by_columns_and_are_those_of_each_letter():
    rnd = random.Random(6)
    texts = [bytes(rnd.choice(b"abc d") for _ in range(rnd.choice([200, 201, 260, 900, 4000]))) for _ in range(60)] + [b"a" * 700]
    named, want = [], []
    for row, data, at, low, high in suffixes._by_piece(pa.record_batch({"bytes": pa.array(texts, pa.binary())}), 200):
        n = suffixes._known(at, len(data))
        name = {j: rnd.randint(1, 999) for j in range(n) if j % 3}
        named.append([{"j": j, "name": x, "needs": 1} for j, x in name.items()] or None)
        for j, p in enumerate(at):
            if high[j] >= low[j]:
                same = (data[low[j] : p + 200], p - low[j], p - high[j], 7 * row, p)
                two = min(at[j + 1] + suffixes.REACH - p, 200) if j + 1 < n else 200
                rest = j % 3 if j < n else 0
                want += [(12, 0, name.get(j, 0), *same)] * (rest > 0) + [(1, suffixes.REACH, name.get(j + 1, 0), *same)] * (rest < 2) + [(2, two, name.get(j + 2, 0), *same)] * (rest != 1)
    kind = pa.list_(pa.struct([("j", pa.int32()), ("name", pa.int64()), ("needs", pa.int32())]))
    batch = pa.record_batch({"pid": pa.array([7 * i for i in range(len(texts))], pa.int64()), "bytes": pa.array(texts, pa.binary()), "names": pa.array(named, kind)})
    got = list(suffixes._runs(200)(iter([batch])))
    assert sorted(tuple(r.values()) for x in got for r in x.to_pylist()) == sorted(want)
    assert all(len(x.column("run").unique()) == 1 for x in got)  # made column by column, a run at a time
