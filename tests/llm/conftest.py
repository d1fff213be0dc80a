from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, wordless, repeated and long texts, with columns whose names clash."""
    copy = "One line of words here.\nA second line of words.\nAnd a third line of words. " * 3
    rows = [
        (1, None, "en", 0, "x"),
        (2, "", None, 0, "x"),
        (3, " \n\t ", "en", 0, "x"),
        (4, copy, "en", 0, "x"),
        (5, copy, "fr", 0, None),
        (5, copy, "fr", 0, None),
        (None, copy, None, None, "y"),
        (6, "!!! 123 ###", "de", 0, "y"),
        (7, "word " * 30_000, "en", 0, "y"),
        (8, "é" * 60 + " naïve", "fr", 0, "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, component_id string")
