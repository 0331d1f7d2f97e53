import random

import numpy as np
import pyarrow as pa

from cardloom.llm import common


def test_components_of_chains_stars_and_random_links(spark):
    rnd = random.Random(0)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(rnd.randint(2000, 2300), rnd.randint(2000, 2300)) for _ in range(150)] + [(5, 5), (-7, 9999)]
    rnd.shuffle(links)
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    alone = {x for x in parent if not any(x in p and p[0] != p[1] for p in links)}
    got = {r.id: r.component for r in common.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
    assert got == {x: find(x) for x in parent if x not in alone}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_and_their_hashes():
    texts = ["a b  cc", None, "", " cc\n", "dd ee cc", "\x1cx\x85y z"]
    for limit in (1, 1 << 20):
        seen = []
        for row, rows, data, offsets in common.text_slices(pa.array(texts, pa.string()), limit):
            s, e, at = common.word_bounds(data, offsets)
            h = common.word_hashes(data, s, e, piece=3)
            raw = data.tobytes()
            for r in range(rows):
                mine = [raw[a:b] for a, b in zip(s[at[r] : at[r + 1]], e[at[r] : at[r + 1]], strict=True)]
                assert mine == (texts[row + r] or "").encode().split()
                seen += list(zip(mine, h[at[r] : at[r + 1]].tolist(), strict=True))
        assert len({w for w, _ in seen}) == len({x for _, x in seen}) == len(set(seen))
    assert np.array_equal(common.runs_hash(np.arange(9, dtype=np.uint64), np.array([2]), np.array([5])), common.runs_hash(np.array([7, 2, 3, 4], np.uint64), np.array([1]), np.array([4])))
