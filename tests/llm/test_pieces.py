import random

import numpy as np
import sentencepiece

from cardloom.llm.common import table
from cardloom.llm.pieces import MODEL, SPACE, Pieces, chosen_states, decode, encode, normalized


def scanned(p, text, chunk):
    s = normalized(text)
    last, reach = max(0, len(s) // chunk - 1), p.longest
    cuts = [(n * chunk, len(s) if n == last else (n + 1) * chunk) for n in range(last + 1)]
    parts = [(s[max(0, a - reach) : a], s[a:b], s[b : b + reach], n == 0, n == last) for n, (a, b) in enumerate(cuts)]
    at = chosen_states([p.transfer(*x) for x in parts]) if last else []
    return np.concatenate([p.traced(*x, e, f) for x, e, f in zip(parts, [0, *at], [*at, 0], strict=True)]).tolist()


def test_scan_equals_the_library():
    with open(MODEL, "rb") as f:
        p = Pieces(f.read())
    rnd = random.Random(7)
    for i in range(150):
        text = "".join(rnd.choice("abcdefghinorst    \n.,éß=-_/0123日") for _ in range(rnd.randint(60, 300)))
        text = text.replace(" ", "") if i % 4 == 0 else text.replace(" ", "     ") if i % 4 == 1 else text
        chunk = rnd.choice([20, 33, 50])
        assert scanned(p, text, chunk) == p.model.encode(text)


def test_encode_and_decode(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").limit(40).collect()]
    texts += ["", " ", "  a  b ", "\n\n x", "tab\there", "é😀日本", "a" * 5000, " " * 3000, f"has {SPACE} sign", "z y " * 4000]
    rows = [*enumerate(texts), (900, None), (None, "no id here"), (3, texts[3]), (3, "z y " * 4000)]
    encoded = encode(docs(*rows), chunk=300)
    assert set(encoded.columns) == {*docs(*rows).columns, "ids"} - {"text"}
    got = encoded.collect()
    want = sorted((str(i), str(None if t is None else model.encode(t))) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.ids)) for r in got) == want
    back = sorted((str(r.doc_id), str(r.text)) for r in decode(encoded).collect())
    assert back == sorted((str(i), str(None if t is None else t.replace(SPACE, " "))) for i, t in rows)
    assert encode(docs(*rows).where("doc_id > 9999")).collect() == []
