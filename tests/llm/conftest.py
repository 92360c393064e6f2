from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from texts (or (doc_id, text) pairs); the other columns may be given."""

    def make(texts, lang="en", source="s"):
        rows = []
        for i, t in enumerate(texts):
            key, text = t if isinstance(t, tuple) else (i, t)
            rows.append((key, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(rows, DOCS)

    return make
