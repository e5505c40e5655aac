import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, spans int, raw string"


@pytest.fixture()
def docs(spark):
    """Makes a table of documents of (doc_id, text, lang, source); other columns have names that operators use inside."""

    def make(rows):
        return spark.createDataFrame([(*r, *([None] * (4 - len(r))), None if r[1] is None else len(r[1]), "x", 1, "y") for r in rows], SCHEMA)

    return make
