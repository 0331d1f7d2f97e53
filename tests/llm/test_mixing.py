import pytest

from cardloom.llm.mixing import mix_sources, mixed, source_targets


def plain_targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Shares by weight; what is above a cap is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets(spark):
    for sizes in ({"a": 100, "b": 10, "c": 1000, None: 50}, {"a": 1, "b": 1000}, {"x": 5}, {"a": 0, "b": 7, "c": 9}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_mix_nears_targets_and_reruns_agree(docs):
    rows = [(i, "w " * (i * 37 % 90 + 1), "en", f"s{i % 10 if i % 10 < 4 else 0}") for i in range(3000)]
    first = {r.doc_id: r for r in mix_sources(docs(*rows)).collect()}
    again = {r.doc_id: r for r in mix_sources(docs(*rows).repartition(7)).collect()}
    assert first == again and len(first) == 3000
    taken, target = {}, {}
    for i, _, _, s in rows:
        taken[s] = taken.get(s, 0) + first[i].taken
        target[s] = first[i].target
    assert all(abs(taken[s] - target[s]) <= 90 for s in taken)  # one document at most
    assert all(r.taken in (0, r.size, 2 * r.size) for r in first.values())


def test_edges(docs):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, "x y", "en", "a"), (3, "x y", "en", "a"), (None, "z z", "en", "b"), (4, "q " * 50_000, "en", "c")]
    got = mix_sources(docs(*rows)).collect()
    assert len(got) == 6 and {r.size for r in got} == {0, 2, 50_000}
    assert sum(r.taken for r in got if r.doc_id in (1, 2)) == 0
    assert mix_sources(docs(*rows).where("doc_id > 99")).collect() == []
    out = mixed(docs(*rows))
    assert out.columns == docs(*rows).columns
    assert out.count() == sum(r.copies for r in got)


def test_repeated_rows_keep_to_the_target(docs):
    from cardloom.llm.mixing import mix_sources, mixed

    rows = [(7, "two words", "en", "a")] * 1000 + [(i, "w " * (i % 30 + 1), "en", "b") for i in range(100, 160)] + [(1, None, "en", "a"), (1, None, "en", "a")]
    got = mix_sources(docs(*rows)).collect()
    assert len(got) == len(rows)
    for size in {r["source_size"] for r in got}:
        of = [r for r in got if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 30
        assert all(r["taken"] <= 2 * r["size"] for r in of)
    a = [r for r in got if r["doc_id"] == 7]
    assert abs(sum(r["taken"] for r in a) - a[0]["target"]) <= 2
    back = mixed(docs(*rows)).where("doc_id = 7").count()
    assert back * 2 == sum(r["taken"] for r in a)
