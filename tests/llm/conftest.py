import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag int, _text string, _key int, kept string"


@pytest.fixture
def make(spark):
    """Documents with further columns whose names clash with those of helpers."""
    def build(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = [((ids or range(n))[i] if ids is None or ids[i] is not None else None, t,
                 langs[i] if langs else "en", sources[i] if sources else "a",
                 len(t) if t is not None else None, i, "x", i, "y") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return build
