"""Small tables and sessions for the corpus operators."""

import pytest

@pytest.fixture
def docs_of(spark):
    """Documents from texts, numbered from 0, with columns whose names operators use themselves."""

    def make(texts, extra=True):
        rows = [(i, t, "made", i % 3, "n") for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, made string, score int, keys string")
        return frame if extra else frame.select("doc_id", "text")

    return make


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
