"""Fixtures of the llm tests, and rows that every operator must take."""

import pytest

from tidemark.llm.store import prepare_workers


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    prepare_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from ``(id, text)``, with columns that operators use themselves."""

    def build(*rows):
        return spark.createDataFrame(
            [(i, text, "x", 1, "y", "z") for i, text in rows],
            "doc_id long, text string, row string, n int, kind string, spans string",
        )

    return build


ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (None, "no id at all here"), (4, "é ü ﬀ\x00 \x1c"),
    (5, "word " * 30_000), (6, "x" * 100_000), (7, "same row twice"), (7, "same row twice"),
]
