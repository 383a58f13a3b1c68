import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*r, *("en", "src1")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return make


