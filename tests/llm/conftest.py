import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and
    columns whose names the operators use themselves."""
    rows = [
        (1, "The quick brown fox. It jumps!\n\nOver  the lazy dog's back.", "en", "s0", 10),
        (1, "The quick brown fox. It jumps!\n\nOver  the lazy dog's back.", "en", "s0", 10),
        (2, None, None, None, None),
        (3, "", "de", "s1", 0),
        (None, "ohne Kennung, aber mit Text", "de", None, None),
        (None, None, None, None, None),
        (4, " \t\n ", "fr", "s1", 4),
        (5, "x" * 5000, "en", "s2", 5000),
        (6, "the lazy dog " * 9000, "en", "s2", 117000),
        (7, "tab\x0bvt\x1cfs\xa0nbsp　wide <|endoftext|> 日本語 é é \U0001f600", "fr", "s3", 1),
        (8, "the quick brown fox. it jumps!\n\nover  the lazy dog's back.", "en", "s0", 10),
        (6, "another text of the same id", "en", "s2", 1),
    ]
    named = [(*r, k, k / 2, "own", -k, f"u{k}", [k]) for k, r in enumerate(rows)]
    schema = DOCS + ", start int, score double, predicted string, root int, fp string, near array<int>"
    return spark.createDataFrame(named, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))
