"""Fixtures of the tests of the training-data operators."""

import public_tokenizers
import pytest

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, start=0):
        """Documents from texts, or from (doc_id, text) pairs; other columns have names that clash."""
        rows = [t if isinstance(t, tuple) else (start + i, t) for i, t in enumerate(texts)]
        rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in rows]
        df = spark.createDataFrame(rows, DOCS)
        return df.selectExpr("*", "1L as n", "'x' as score", "2 as block", "'y' as id", "0 as toxic_", "3L as length")

    return make


@pytest.fixture(scope="session")
def odd_texts():
    return [None, "", " \n\t", "word", "Word word WORD", "é è x  y", "long " * 30000, "same text here now", "same text here now"]
