import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of texts, ids counting from 0, with columns whose names the operators use inside."""
    def make(texts, ids=None):
        rows = [(i, t, "en", None, None if t is None else len(t), 7, "x") for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, DOCS + ", bucket int, id string")
    return make


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))
