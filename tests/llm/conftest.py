import pytest


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text) pairs; a third entry is the source. An extra column has a name operators use."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), k) for k, r in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, row long").repartition(3)

    return make
