"""Small tables with the awkward cases, for all operators."""

import pytest

LONG = "the long story of a word and another one " * 3000


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) with NULLs, empty, wordless and long texts, ties and repeated rows."""
    return [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (2, None), (3, ""), (4, " \t\n "), (5, "one"), (6, "one"), (7, LONG),
        (8, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (8, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (None, "a row without an id"), (None, None), (9, "Ünïcode ßtraße \U0001f600 naïve word"), (10, "!!! ??? ..."),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with a source, a language and columns whose names operators use themselves."""
    rows = [(i, t, "en" if i else None, None if i == 5 else f"s{(i or 0) % 2}", k, "x", "y")
            for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, mix_cut string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
