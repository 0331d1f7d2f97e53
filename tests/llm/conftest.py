import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, fp long, size int"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, lang, source); further columns clash with names that operators use inside."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), 7, 8, 9) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
