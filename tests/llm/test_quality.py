from cardloom.llm.quality import line_quality

GOOD = "\n".join(f"Line{i} holds{i} words{i}, number{i} of{i} twelve{i}." for i in range(12))


def test_edges_and_verdicts(docs):
    menu = GOOD + "\n" + "\n".join(f"Home{i} | News{i} | Shop{i} | Help{i} | Jobs{i}" for i in range(12)) + "\nalso this\nalso this"
    noise = " ".join(f"w{i}###" for i in range(80))
    rows = [(1, GOOD), (2, None), (3, ""), (4, " \n\t"), (5, menu), (6, noise), (7, "buy now " * 40), (8, GOOD + "\nCookie Policy"), (8, GOOD + "\nCookie Policy"), (None, GOOD), (9, "word " * 60_000)]
    got = {r.doc_id: r for r in line_quality(docs(*rows)).collect()}
    assert len(line_quality(docs(*rows)).collect()) == len(rows)
    assert {i for i, r in got.items() if r.kept} == {1, 8, None}
    assert got[8].clean_text == GOOD and got[2].clean_text is None
    assert (got[2].n_words, got[3].n_words, got[4].n_words, got[2].base_failed) == (0, 0, 0, True)
    assert got[5].n_dup_lines == 1 and got[5].n_lost_words == 12 * 9 and not got[5].base_failed
    assert (got[7].n_repeat_words, got[9].n_repeat_words) == (80, 60_000)
    assert line_quality(docs((1, "a")).where("doc_id > 5")).collect() == []
