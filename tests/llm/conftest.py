import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, ids from 0, with extra columns whose names the operators use inside."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", "s", None if t is None else len(t), 1, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, line int, h string")

    return make
