import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text, lang, source) tuples."""
    def make(rows):
        return spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
