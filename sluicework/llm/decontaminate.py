"""Benchmark decontamination by a broadcast hash set of the test items' word windows.

DataFrame functions only.  A document's words are taken in windows of 13 (and of the lengths of
shorter items), each window probes the table of benchmark windows by a hash of ``PROBED`` of its
words, and a hit is verified word by word in the join.  Documents do not move for the probe: the
table is broadcast when its counted rows are at most ``BROADCAST_WINDOWS``.  Else the windows'
hashes are joined by shuffle, without the documents' words, and the few that meet are verified in a
second join by document, for which each document moves once.  Only hits are grouped by document.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.columns import let, positions, same_row, text_key

# Fixed values of the contamination rule.
WINDOW = 13
HIT_SHARE = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Words of a window that its hash takes, evenly spread; all words are compared on a hit.
PROBED = 4

# About 300 bytes each as Spark holds them.
BROADCAST_WINDOWS = 200_000


def normal_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAK), "")


def count_words(text: Column) -> Column:
    """The same words counted, without lower-casing."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK_ANY_CASE), ""))


def _probe(found: Column, start: Column | int, length: int) -> Column:
    """The hash of a window's first and last word and some between."""
    taken = min(PROBED, length)
    steps = [round(k * (length - 1) / max(1, taken - 1)) for k in range(taken)]
    return F.xxhash64(*[F.get(found, start + F.lit(k)) for k in steps])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``length, words, item_ids``: each distinct window once, with the items that have it.

    An item without words has none.  An item without an id keeps its windows but is in no list.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), normal_words(F.col("text")).alias("words")
    ).filter(F.size("words") > 0)
    length = F.least(F.lit(window), F.size("words"))
    return (
        items.select(
            "item_id",
            length.alias("length"),
            F.explode(
                F.transform(
                    positions(F.size("words") - length + 1),
                    lambda i: F.slice(F.col("words"), i + 1, length),
                )
            ).alias("words"),
        )
        .groupBy("length", "words")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, place, length, item_ids``: where benchmark windows occur."""
    table = benchmark_windows(benchmark, window)
    # One row per length, at most ``window`` of them.
    counted = table.groupBy("length").agg(F.count("*").alias("n")).collect()
    sizes = {row["length"]: row["n"] for row in counted}
    lengths = sorted(sizes) or [window]

    def of_length(found: Column, length: int) -> Column:
        return F.transform(
            positions(F.size(found) - (length - 1)), lambda start: _probe(found, start, length)
        )

    def count(length: int) -> Column:
        return F.greatest(F.col("n_found") - (length - 1), F.lit(0))

    def hashed(found: Column) -> Column:
        arrays = [of_length(found, length) for length in lengths]
        return arrays[0] if len(arrays) == 1 else F.concat(*arrays)

    # The arrays of the lengths stand one behind the other; a hit's place tells which it is of.
    broadcast = sum(sizes.values()) <= BROADCAST_WINDOWS
    whole = docs.select("doc_id", text_key(), normal_words(F.col("text")).alias("found"))
    probes = whole.select(
        "doc_id",
        "text_key",
        *(["found"] if broadcast else []),
        F.size("found").alias("n_found"),
        F.posexplode(let(F.col("found"), hashed)).alias("at", "hash"),
    )
    place, length, before = F.col("at"), F.lit(lengths[0]), F.lit(0)
    for shorter, longer in pairwise(lengths):
        before = before + count(shorter)
        place = F.when(F.col("at") >= before, F.col("at") - before).otherwise(place)
        length = F.when(F.col("at") >= before, F.lit(longer)).otherwise(length)
    key = F.lit(None).cast("long")
    for of in lengths:
        key = F.when(F.col("length") == of, _probe(F.col("words"), F.lit(0), of)).otherwise(key)
    table = table.select(F.col("length").alias("size"), key.alias("key"), "words", "item_ids")
    at_hit, of_size = (place, length) if broadcast else (F.col("place"), F.col("size"))
    # Not an equality of arrays, which would become a join key and be cut out for every window.
    verified = F.forall(
        F.zip_with(
            F.slice(F.col("found"), at_hit + 1, of_size),
            F.col("words"),
            lambda ours, theirs: ours.eqNullSafe(theirs),
        ),
        lambda equal: equal,
    )
    met = F.col("hash") == F.col("key")
    if broadcast:
        return probes.join(F.broadcast(table), met & verified).select(
            "doc_id", "text_key", place.alias("place"), F.col("size").alias("length"), "item_ids"
        )
    narrow = probes.select(
        "doc_id", "text_key", place.alias("place"), length.alias("length"), "hash"
    )
    # Once per document, so rows that repeat do not pair with each other.
    near = (
        narrow.join(table.hint("merge"), met & (F.col("length") == F.col("size")))
        .select("doc_id", "text_key", "place", "size", "words", "item_ids")
        .dropDuplicates(["doc_id", "text_key", "place", "size", "words"])
    )
    whole = whole.select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "found"
    )
    same = near["doc_id"].eqNullSafe(whole["__id"]) & (near["text_key"] == whole["__key"])
    return whole.join(near.hint("merge"), same & verified).select(
        "doc_id", "text_key", "place", F.col("size").alias("length"), "item_ids"
    )


def _judged(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    docs = docs.select("doc_id", "text")
    found = hits(docs, benchmark, window)
    # What is collected per document is bounded by its number of words.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("words")),
        lambda seen, span: F.struct(
            F.greatest(seen["to"], span["place"] + span["length"]).alias("to"),
            (
                seen["words"]
                + F.greatest(
                    F.lit(0), span["place"] + span["length"] - F.greatest(seen["to"], span["place"])
                )
            ).alias("words"),
        ),
        lambda seen: seen["words"],
    )
    ids = F.array_sort(F.array_distinct(F.flatten("listed")))
    per_document = (
        found.groupBy("doc_id", "text_key")
        .agg(
            F.collect_set(F.struct("place", "length")).alias("spans"),
            F.collect_set("item_ids").alias("listed"),
        )
        .select("doc_id", "text_key", covered.alias("n_hit"), ids.alias("ids"))
    )
    base = docs.select("doc_id", text_key(), count_words(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("ids", F.array().cast("array<string>"))
    return base.join(per_document, same_row(base, per_document), "left").select(
        base["doc_id"],
        base["text_key"],
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word inside any occurrence of a window is hit.  A document is contaminated when it has a hit
    and at least 1 in ``HIT_SHARE`` of its words is hit.  A null or empty text has no words and no
    hits; an empty benchmark hits nothing; rows that repeat are answered each, rows with one
    ``doc_id`` are told apart by their text.  Other columns are ignored.
    """
    return _judged(docs, benchmark, window).drop("text_key")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = (
        _judged(docs, benchmark, window)
        .filter("contaminated")
        .select(F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_key"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(bad["__bad_id"]) & (
        F.xxhash64(docs["text"]) == bad["__bad_key"]
    )
    return docs.join(bad.hint("merge"), same, "left_anti")
