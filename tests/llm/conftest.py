"""Small documents with the cases every operator must take."""

from __future__ import annotations

import pytest

# Cases: null and empty texts, blanks, ties, repeated rows, a null id, one very long text, columns with clashing names.
LONG = " ".join(f"word{i % 977} {i % 13}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    base = "the quick brown fox jumps over the lazy dog and runs away from the hunter in the deep dark wood"
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, base, "en"), (5, base, "en"),
        (6, base.upper(), "en"), (7, base + " today", "en"), (7, base + " today", "en"), (None, base, "en"),
        (8, LONG, "en"), (9, "Une phrase à lire\nUne phrase à lire\nUne phrase à lire", "fr"),
        (10, "123 456 !!! ###", "en"), (11, "漢字 かな ​ x\x1cy İı ſ", "ja"), (12, "a\u0000b <|endoftext|> c", "en"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(
        [(i, t, x, "s", 0, 1.5, "clash") for i, t, x in odd_rows],
        "doc_id long, text string, lang string, source string, n_lines int, score double, component_id string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
