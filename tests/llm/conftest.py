import random

import pytest

from llm_helpers import DOCS, prose


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows, and columns with names of our own."""
    rng = random.Random(1)
    long_text = prose(rng, 60_000)
    rows = [
        (1, prose(rng, 80), "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0), (None, prose(rng, 70), "xx", "b", 5),
        (4, " \t\n ", "de", "b", 4), (5, long_text, "fr", None, 9), (6, "###", "es", "c", 3), (7, prose(rng, 90), "en", "c", 8),
        (7, "one", "en", "c", 3), (8, "Привет мир " * 60, None, "d", 3), (9, "💥 x\ud7ff y", "en", "d", 3),
    ]
    rows += [rows[0], rows[0]]
    extra = [(*r, i, "x", 0.5, [1.0]) for i, r in enumerate(rows)]
    return spark.createDataFrame(extra, DOCS + ", size long, node string, score double, x array<double>")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (5, 0, 1), (7, 1, 1), (6, None, None), (None, 1, 1), (1, 1, 0), (999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
