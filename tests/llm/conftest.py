import os
import tempfile

import pytest


@pytest.fixture()
def sf(spark):
    return os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture()
def frame(spark):
    """A documents table of given (doc_id, text) rows, with columns whose names operators use too."""
    def make(rows, lang="en", source="s"):
        data = [(i, t, lang, source, None if t is None else len(t), 1.0, "k") for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score double, key string")
    return make


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="qualstar-llm-test-")
