"""Quality rules: per-text counts, and lines that too many documents of a host repeat.

``line_quality`` works with DataFrame functions only.  Every text is looked at whole.  The counts
need no shuffle.  A line counts its distinct documents per host: rows are first made one per host, line
and document, spread by all three, and only their sums meet per line, so a line in a third of all
documents is one row per task there; the lines above the limit then meet the documents' lines in a
salted join, so such a line is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.columns import SPACE, SPACE_RUN, let, positions, same_row, text_key, words

# Fixed values of the base rule.
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

# Limits of the line rule: a line may be in so many documents of a host, whichever is more.
LINE_DOCUMENTS = 10
LINE_PERCENT = 5
# A document is depleted when over this share of its words stands in removed lines.
DEPLETED_PERCENT = 50
SALTS = 16


def repeated_words(found: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, windows told apart by a hash.

    Windows are sorted by hash, so equal ones are neighbours, and the covered words follow from the
    sorted places of those that have an equal neighbour.
    """

    def places(windows: Column) -> Column:
        def repeated(i: Column) -> Column:
            own = F.get(windows, i)
            equal = F.lit(False)
            for other in (F.get(windows, i - 1), F.get(windows, i + 1)):
                equal = equal | F.coalesce(own["hash"] == other["hash"], F.lit(False))
            return F.when(equal, own["place"])

        marked = F.transform(positions(F.size(windows)), repeated)
        return F.array_sort(F.array_compact(marked))

    def windows(w: Column) -> Column:
        hashed = F.transform(
            positions(F.size(w) - (WINDOW - 1)),
            lambda i: F.struct(
                F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]).alias("hash"),
                i.alias("place"),
            ),
        )
        return F.array_sort(hashed)

    def covered(sorted_places: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("words"))
        return F.aggregate(
            sorted_places,
            start,
            lambda seen, place: F.struct(
                place.alias("last"),
                (seen["words"] + F.least(F.lit(WINDOW), place - seen["last"])).alias("words"),
            ),
            lambda seen: seen["words"],
        )

    return covered(let(let(found, windows), places))


def base_counts(text: Column) -> dict[str, Column]:
    """The counts of one text by name; ``words`` is evaluated once for two of them."""
    known = F.coalesce(text, F.lit(""))
    blank = F.regexp_replace(known, SPACE_RUN, "")
    lines = F.filter(F.split(known, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)
    both = let(
        words(text),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated")),
    )
    return {
        "counted": both,
        "word_chars": F.length(blank).cast("long"),
        "n_symbols": F.regexp_count(known, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(
            lines, lambda found: F.size(found) - F.size(F.array_distinct(found))
        ).cast("long"),
    }


def _normal_lines() -> Column:
    """Lines lower-cased, their words one space apart; empty where a line has no word."""
    return F.transform(
        F.split(F.col("text"), "\n"),
        lambda line: F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACE)), SPACE_RUN, " ")),
    )


def _host() -> Column:
    return F.coalesce(F.col("source"), F.lit("")).alias("host")


def _line_hash() -> tuple[Column, Column]:
    return F.xxhash64("line").alias("line_hash"), F.hash("line").alias("line_check")


def _document_lines(docs: DataFrame) -> DataFrame:
    """A row per line with a word: its place, its hash and its number of words."""
    rows = (
        docs.select("doc_id", text_key(), _host(), _normal_lines().alias("lines"))
        .select("doc_id", "text_key", "host", F.posexplode("lines").alias("place", "line"))
        .filter(F.col("line") != "")
    )
    return rows.select(
        "doc_id",
        "text_key",
        "host",
        "place",
        *_line_hash(),
        (F.regexp_count("line", F.lit(" ")) + 1).alias("line_words"),
    )


def frequent_lines(
    docs: DataFrame,
    line_documents: int = LINE_DOCUMENTS,
    line_percent: int = LINE_PERCENT,
) -> DataFrame:
    """``host, line_hash, line_check, n_docs`` of the lines above the limit of their host."""
    distinct = F.array_distinct(F.filter(_normal_lines(), lambda line: line != ""))
    counts = (
        docs.select("doc_id", _host(), F.explode(distinct).alias("line"))
        .groupBy("host", *_line_hash())
        .agg(F.count_distinct("doc_id").alias("n_docs"))
    )
    hosts = docs.groupBy(_host()).agg(F.count("*").alias("host_docs"))
    return (
        counts.filter(F.col("n_docs") > line_documents)
        .join(hosts, "host")
        .filter(100 * F.col("n_docs") > line_percent * F.col("host_docs"))
        .drop("host_docs")
    )


def line_quality(
    docs: DataFrame,
    line_documents: int = LINE_DOCUMENTS,
    line_percent: int = LINE_PERCENT,
    depleted_percent: int = DEPLETED_PERCENT,
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``source``) its counts and the verdict.

    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows.
    ``kept``: not failed, and at most ``depleted_percent`` of the words stand in lines that more
    documents of the host share than ``max(line_documents, line_percent of its documents)``.

    A null or empty text has counts of 0 and fails.  A null source is a host of its own.  Rows
    with one ``doc_id`` count as one document for a line, rows without an id as none; of the host's
    documents each row is one.  Rows with one ``doc_id`` are told apart by their text.  Other columns are ignored.  Output: ``doc_id``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``,
    ``n_line_words`` (words in removed lines).
    """
    docs = docs.select("doc_id", "text", "source")
    lines = _document_lines(docs).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS))
    )
    frequent = frequent_lines(docs, line_documents, line_percent).select(
        "host",
        "line_hash",
        "line_check",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"),
    )
    removed = (
        lines.join(frequent, ["host", "line_hash", "line_check", "salt"])
        .groupBy("doc_id", "text_key", "place")
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("doc_id", "text_key")
        .agg(F.sum("line_words").alias("n_line_words"))
    )
    counts = base_counts(F.col("text"))
    base = docs.select("doc_id", text_key(), *[c.alias(name) for name, c in counts.items()])
    n_words, n_repeat = F.col("counted.n"), F.col("counted.repeated")
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words)
    n_line_words = F.coalesce("n_line_words", F.lit(0)).cast("long")
    return base.join(removed, same_row(base, removed), "left").select(
        base["doc_id"],
        n_words.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        n_repeat.cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (100 * n_line_words <= depleted_percent * n_words)).alias("kept"),
        n_line_words.alias("n_line_words"),
    )
