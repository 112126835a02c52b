"""Texts and rows that are hard on every corpus operator; tests import what they use."""

import pytest

EDGE_TEXTS = [
    None,
    "",
    "   \n\t\n",
    "one",
    "The quick brown fox jumps over the lazy dog while many people watch it run home today.",
    "The quick brown fox jumps over the lazy dog while many people watch it run home today.",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 400,
    "ÉÈ 漢字 😀 ▁ \x00 %%% ### !!! 123",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, "src1" if i % 3 else None, "x", 1.5) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[4], (None, EDGE_TEXTS[4], None, None, None, None), (None, None, None, None, None, None)]
    columns = "doc_id long, text string, lang string, source string, row string, score double"
    return spark.createDataFrame(rows, columns)
