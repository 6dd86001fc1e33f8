import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A maker of documents from (doc_id, text, source) rows, with a clashing column."""

    def make(rows, extra="score"):
        made = spark.createDataFrame(
            [(i, t, "en", s, len(t or "")) for i, t, s in rows], DOC)
        return made.selectExpr("*", f"'own' AS {extra}")

    return make
