from __future__ import annotations

import pytest
from odd_texts import prose

SCHEMA = "doc_id long, text string, lang string, n int, id string, score string, label string, key int, role int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and long texts, repeated rows and ids, copies, odd characters."""
    base = prose(1, 60)
    texts = [
        (0, base),
        (1, base),
        (2, base.replace(" ", "  ", 5).upper()),
        (3, None),
        (4, ""),
        (5, "   \n\t"),
        (6, "word"),
        (7, "WORD"),
        (None, base),
        (None, None),
        (8, prose(2, 30_000)),
        (9, "twice the same row"),
        (9, "twice the same row"),
        (10, prose(3, 20)),
        (10, prose(4, 20)),
        (11, "12345 67 -- !!"),
        (12, "x" * 5_000),
        (13, "▁ é 中文 😀 \x00 <|endoftext|> <s> don't ſ İ"),
        (14, base + " and one more word"),
    ]
    return [(k, text, None if k in (3, 5) else "en", 1, "a", "b", "c", 2, 3) for k, text in texts]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = "doc_id long, quality int, toxic int, text string, score double"


@pytest.fixture
def odd_labels(spark):
    rows = [(0, 1, 0), (0, 1, 0), (4, 0, 0), (6, 0, 1), (7, None, None), (None, 1, 1), (999, 0, 1), (8, 1, 0), (11, 0, 0), (2, 1, 1)]
    return spark.createDataFrame([(*row, "t", 0.5) for row in rows], LABELS)


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
