import pytest

from pingline.llm.common import prepare


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(ready):
    """Documents from (doc_id, text[, lang]) rows, with columns whose names clash with the operators' own."""

    def make(rows):
        rows = [(*r, "en")[:3] for r in rows]
        data = [(i, t, l, "s", 0, 7, "x", 1, 2) for i, t, l in rows]
        return ready.createDataFrame(
            data, "doc_id long, text string, lang string, source string, n_chars long, row long, found string, fp long, ids int")

    return make
