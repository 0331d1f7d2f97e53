import random

import corpus_pipeline
from cardloom.llm.neardup import Texts
from cardloom.llm.simhash import fingerprint


def jaccard(x, y):
    x, y = (Texts(5).shingles(" ".join(t.lower().split())) for t in (x, y))
    return len(x & y) / len(x | y)


def test_edited_copies_go_and_others_stay(spark, docs):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    rows, far, copies = [], 0, set()
    for i in range(60):
        w = [word() for _ in range(rnd.choice([30, 60, 120, 400]))]
        rows.append((10 * i, " ".join(w)))
        for k in (1, 2, 3):
            v = list(w)
            for at in rnd.sample(range(len(v)), max(1, len(v) * k // 60)):
                v[at] = word()
            rows.append((10 * i + k, "\n".join(v) if k == 2 else " ".join(v)))
            if jaccard(rows[-1][1], " ".join(w)) >= 0.8:
                copies.add(10 * i + k)
                far += ((fingerprint(rows[-1][1].encode()) ^ fingerprint(" ".join(w).encode())) % (1 << 64)).bit_count() > 2
    rows += [(None, rows[0][1].upper()), (9000, None), (9001, " "), (9002, "two words"), (9003, "Two words"), (9004, "two word")]
    kept = corpus_pipeline.drop_near_copies(spark, docs(*rows), "").collect()
    assert far > 40  # what SimHash alone leaves
    left = [r.text for r in kept if r.text and r.text.strip()]
    alike = [1 for i, x in enumerate(left) for y in left[:i] if jaccard(x, y) >= 0.8]
    assert not alike
    ids = {r.doc_id for r in kept}
    assert {10 * i for i in range(60)} | {9000, 9002, 9004} <= ids and not ids & {None, 9001, 9003}
    assert len(copies & ids) == 0
    for r in kept:  # nothing goes without a text like it
        assert kept[0].asDict().keys() == set(docs(*rows).columns)
    for i, t in rows:
        if i is not None and i < 9000 and i not in ids:
            assert any(jaccard(t, x) >= 0.8 or ((fingerprint(t.encode()) ^ fingerprint(x.encode())) % (1 << 64)).bit_count() <= 2 for _, x in rows if x and x.strip() and x != t)
