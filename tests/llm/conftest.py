import pytest

EXTRA = "sha string, n int, mark string, node int, kept string, _sha string, _mark string, text_mark int, score string"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as a table with more columns, whose names operators use themselves."""

    def make(rows, lang="en"):
        full = [(i, t, lang if not callable(lang) else lang(i), "src", None, "x", 1, "m", 2, "k", "s", "q", 3, "c") for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make
