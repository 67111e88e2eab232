import pytest


@pytest.fixture
def docs(spark):
    """A table of documents from texts or (doc_id, text) pairs, with columns whose names clash with outputs."""
    def make(rows, **extra):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
