"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, as characters and as a pattern.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, also where ``body`` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The runs of characters that are not white space; none for null."""
    trimmed = F.btrim(text, F.lit(SPACE))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(none)


def positions(count: Column) -> Column:
    """0 .. count - 1, empty for a count below 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )


def text_key() -> Column:
    """Tells rows with one ``doc_id`` apart by their text; equal rows share it."""
    return F.xxhash64(F.col("text")).alias("text_key")


def same_row(left, right) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])
