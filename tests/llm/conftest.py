from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dockflow.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns with the operators' own names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "One small text about a harbour and its boats at night.", "en", "src1"), (1, "One small text about a harbour and its boats at night.", "en", "src1"),
        (1, "Another text with the same id.", "en", "src1"), (None, "A text without an id.", "en", None), (None, "A text without an id.", None, "src2"),
        (None, None, None, None), (2, None, "en", "src2"), (3, "", "de", "src3"), (4, "   \n\t ", "de", "x"), (5, "12345 !!!", "fr", "src0"),
        (6, long, "en", "src0"), (7, long + " end", "en", "src0"), (8, "ONE SMALL TEXT ABOUT A HARBOUR AND ITS BOATS AT NIGHT.", "en", "src1"), (9, "Àé ü", "fr", "src9"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ("n_chars", "row", "copy", "text_key", "epoch", "taken", "digest", "path", "leaf", "n", "kept", "score", "tokens")
    return frame.select("*", *(F.lit(7).alias(c) for c in clash))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
