import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts; ids count from 0, sources alternate."""

    def make(texts, sources=("a", "b"), ids=None):
        rows = [
            (i if ids is None else ids[i], t, "en", sources[i % len(sources)], None if t is None else len(t)) for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
