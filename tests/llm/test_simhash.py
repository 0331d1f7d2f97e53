import random

import xxhash

from cardloom.llm.common import table
from cardloom.llm.queries import QUERIES
from cardloom.llm.simhash import LEAST_LISTS, QUADRUPLES, fingerprint, fingerprint_links, near_dedup, postings, simhash_components, tallied_pairs


def test_fingerprint_bit_by_bit():
    for text in ("The cat Sat on the mat mat", "one two", "x", "ÄB c d", "a a a a a a"):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert fingerprint(text.encode()) % (1 << 64) == want
    assert fingerprint(b" \n ") == 0


def groups(fps):
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def joined(links, fps):
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_links_keep_every_component_in_short_and_long_lists(spark):
    rnd = random.Random(1)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:8]:
        for _ in range(25):
            f ^= 1 << rnd.randrange(64)
            fps.add(f)
    want = groups(fps)
    for longest in (2, 64):
        df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in fingerprint_links(df, longest).collect()]
        assert joined(links, fps) == want


def test_edges(docs):
    rows = [(5, "same text here now"), (3, "same text here now"), (3, "same text here now"), (9, None), (8, ""), (7, " \n"), (None, "alone in this one"), (None, "same text here now"), (20, "y " * 5000)]
    got = {(r.doc_id, r.fp == 0): r.component_id for r in simhash_components(docs(*rows)).collect() if r.doc_id is not None}
    assert got == {(5, False): 3, (3, False): 3, (9, True): 7, (8, True): 7, (7, True): 7, (20, False): 20}
    kept = near_dedup(docs(*rows))
    assert kept.columns == docs(*rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["20", "3", "7", "None"]
    assert simhash_components(docs(*rows).where("doc_id > 99")).collect() == []


def test_the_tally_counts_six_shared_bytes_exactly(spark):
    assert len(QUADRUPLES) == 14
    rnd = random.Random(3)
    fps = [rnd.getrandbits(63)]
    for n in range(1, 6):
        for _ in range(6):
            x = fps[0]
            for k in rnd.sample(range(8), n):
                x ^= rnd.randrange(1, 128) << 8 * k
            fps.append(x)
    got = {(r.a, r.b): r.lists for r in tallied_pairs(postings(spark.createDataFrame([(f,) for f in set(fps)], "fp long")).select("key", "fp")).collect()}
    shared = lambda a, b: sum((a ^ b) >> 8 * k & 255 == 0 for k in range(8))
    for a in set(fps):
        for b in set(fps):
            if a < b:
                assert (got.get((a, b), 0) >= LEAST_LISTS) == (shared(a, b) >= 6)
                assert got.get((a, b), 0) in {8: {14}, 7: {7}, 6: {3}, 5: {1}}.get(shared(a, b), {0, 1})


def test_query_equals_every_pair_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    fp = {i: fingerprint((t or "").encode()) % (1 << 64) for i, t in texts.items()}
    of = groups(set(fp.values()))
    low = {}
    for i in sorted(texts):
        low.setdefault(of[fp[i]], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, sf).collect()}
    assert got == {i: (f"{fp[i]:016x}", low[of[fp[i]]]) for i in texts}


def test_columns_that_clash_come_back(spark):
    names = ["doc_id", "text", "_version", "version", "row", "of_doc", "of", "stays", "fp", "component_id"]
    df = spark.createDataFrame([(i, "a few words of text", *(f"{n}{i}" for n in names[2:])) for i in (4, 2)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    assert [tuple(r) for r in near_dedup(df).collect()] == [(2, "a few words of text", *(f"{n}2" for n in names[2:]))]
    assert near_dedup(df).columns == names
