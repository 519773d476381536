"""Fixtures of the corpus operators' tests; the session comes from the tests' own conftest."""

from __future__ import annotations

import random

import pytest


@pytest.fixture
def prose():
    """A maker of texts over a vocabulary of invented words, the same for a seed."""

    def make(seed: int, words: int, kinds: int = 400, lines: int = 1) -> str:
        rng = random.Random(seed)
        parts = ["ba", "ko", "ri", "tu", "se", "mo", "na", "li"]
        known = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(kinds)]
        found = [rng.choice(known) for _ in range(words)]
        cut = max(1, words // lines)
        return "\n".join(" ".join(found[i : i + cut]) for i in range(0, words, cut))

    return make


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns that operators also use."""

    def make(rows):
        full = [(*row, *("en", "src")[len(row) - 2 :]) for row in rows]
        values = [(*row, None, 1, "x", "y") for row in full]
        return spark.createDataFrame(
            values,
            "doc_id bigint, text string, lang string, source string, n_chars bigint,"
            " text_key int, n string, host string",
        )

    return make
