import corpus_pipeline
from cardloom.llm.common import table
from cardloom.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece"]
    docs = table(spark, SF, "documents")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert lines.count() == docs.count() and lines.where("n_chars <> char_length(text)").count() == 0
    alone = corpus_pipeline.drop_near_copies(spark, docs, SF)
    kept = alone.collect()
    found = [fingerprint(r.text.encode()) for r in kept]
    assert all(((a ^ b) % (1 << 64)).bit_count() > 2 for i, a in enumerate(found) for b in found[:i])
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "ids"} <= set(out.columns) and out.count() > 0
