from __future__ import annotations

import pytest

#: Rows that upset an operator: nulls, empty and blank texts, ties, a repeated row,
#: an id with two texts, a row without an id.
ODD = [
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "one two three four five six seven", "en", "a", 33),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (4, " \t\n ", "en", "b", 4),
    (5, "short", "de", "b", 5),
    (6, "ß ñ 中文 🙂 " * 30, "es", "c", 270),
    (7, "first text of seven", "en", "c", 19),
    (7, "second text of seven, which is another", "en", "c", 38),
    (None, "a row without an id", "en", "c", 19),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def make(spark):
    """Documents from texts; ids from 1."""

    def documents(*texts):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, 1)], SCHEMA)

    return documents


@pytest.fixture
def prose():
    """Repeatable prose of n words; another seed gives other words."""
    import random

    def words(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))

    return words
