"""Small documents that every text operator must survive."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, schema=DOC_SCHEMA, parts=3):
        return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls in every column, empty, blank and very long texts, repeated rows."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    return docs_of([
        (1, "The quick brown fox jumps over the lazy dog", "en", "s0", 43),
        (1, "The quick brown fox jumps over the lazy dog", "en", "s0", 43),
        (2, "", "en", "s0", 0),
        (3, None, None, None, None),
        (4, " \t\n\x0b\x0c\r ", "de", "s1", 7),
        (None, "no id here", None, "s1", 10),
        (5, long_text, "en", "s0", len(long_text)),
        (6, "é ß 漢字 \U0001f600  x\x85y", "fr", "s2", 12),
        (7, "one", "en", "s0", 3),
        (8, "the QUICK brown fox jumps over the lazy dog", "en", "s0", 43),
    ])
