import pytest
from pyspark import cloudpickle

import webgraph_spark

cloudpickle.register_pickle_by_value(webgraph_spark)

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text[, lang[, source]])."""

    def make(rows, extra=""):
        full = [(*r, *["en", "web"][len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT) if full else spark.createDataFrame([], DOCUMENT)

    return make


@pytest.fixture
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
