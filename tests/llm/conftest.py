import pytest

from estrato.llm.common import ensure_importable


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    ensure_importable(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns beside doc_id and text, some named like those the operators add."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, score double, n_words long, row long, chunk long, leaf string"
        return spark.createDataFrame([(i, t, "en", 0.5, 1, 2, 3, "x") for i, t in rows], schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def spiky_rows():
    """NULLs, empty and blank texts, a very long text, repeated rows, ties and a group of copies."""
    return [(1, None), (2, ""), (3, " \t\n "), (4, "a b c"), (4, "a b c"), (None, "a b c"), (None, None), (5, "word " * 60_000)] + [(10 + k, "same text\nin many rows\nof the table") for k in range(40)]
