"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model predicts bytes as they are from the ``BYTE_ORDER - 1`` before them.  It learns from all
documents that a label trusts and that are not in the calibration fold.  Counts are taken per task
and summed by n-gram; discounts come from the counts of counts.  The table of n-grams and contexts
grows with the corpus and stays sharded.  Documents are dealt into slices; a slice's distinct
n-grams of all orders are joined with the table, and what is found goes back to the slice, where a
document's perplexity is summed over its whole text.

Below the single bytes stands a model of ``ORDER`` characters folded to ``SYMBOLS`` classes, made
from the same counts.  Its codes are below ``SYMBOLS ** ORDER``, so every task gets it.

Each language's threshold is a quantile of the perplexities of its trusted calibration documents,
which the model has not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.arrow import give_back, give_back_driver, map_batches
from sluicework.llm.bit_filter import BitFilter
from sluicework.sources.storage import Staging

BITS = 5
SYMBOLS = 1 << BITS
ORDER = 4
# The n-grams of bytes; a key is a code below 256 ** BYTE_ORDER with its length above it.
BYTE_ORDER = 6
KEY_SHIFT = 8 * BYTE_ORDER
# Share of the trusted documents of a language that the threshold keeps.
QUANTILE = 0.99
# One fold of so many of the trusted documents sets the thresholds; the others are learnt from.
FOLDS, CALIBRATION = 4, 0
# A language with fewer calibration documents takes the threshold of all.
LEAST_CALIBRATION = 20
# Discounts of counts 1, 2, and 3 or more, where the counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)
# Text that is made into n-grams at once; a worker holds some ten times as much.
SLICE_BYTES = 1 << 19
# Text of a slice whose n-grams are joined as one, and the least number of slices.
JOINED_BYTES = 64 << 20
LEAST_SLICES = 6
# A task sends what it has counted when it holds so many n-grams, and what it has packed by size.
COUNTED_GRAMS = 4 << 20
PACKED_BYTES = 8 << 20
# Keys of a slice go out in parts of so many.
SENT_KEYS = 1 << 18


def _classes() -> np.ndarray:
    """Letters by themselves without case; white space, digits, two kinds of marks, symbols and
    bytes beyond ASCII as a class each."""
    table = np.full(256, SYMBOLS - 1, np.uint8)
    table[33:127] = 30
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i
    table[:33] = 26
    table[ord("0") : ord("9") + 1] = 27
    table[[ord(c) for c in ".,;:'\"()-"]] = 28
    table[[ord(c) for c in "!?"]] = 29
    return table


CLASSES = _classes()
CLASS_BYTES = np.bincount(CLASSES, minlength=SYMBOLS)


def byte_codes(texts: list[bytes], order: int = BYTE_ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte as a number, and each text's length in bytes.

    Before a text stands white space, so no n-gram reaches into another text.
    """
    pad = b" " * (order - 1)
    raw = np.frombuffer(pad.join([b"", *texts]), np.uint8).astype(np.int64)
    codes = raw[order - 1 :].copy()
    for back in range(1, order):
        codes |= raw[order - 1 - back : len(raw) - back] << (8 * back)
    lengths = np.array([len(t) for t in texts], np.int64)
    keep = np.ones(len(codes), bool)
    ends = np.cumsum(lengths + order - 1)[:-1]
    for k in range(order - 1):
        keep[ends - (order - 1) + k] = False
    return codes[keep], lengths


def folded(codes: np.ndarray) -> np.ndarray:
    """The n-grams of classes that the last ``ORDER`` bytes of n-grams of bytes make."""
    out = np.zeros(len(codes), np.int32)
    for back in range(ORDER):
        out |= CLASSES[(codes >> (8 * back)) & 255].astype(np.int32) << (BITS * back)
    return out


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of classes that ends at each byte, and each text's length in bytes."""
    codes, lengths = byte_codes(texts, ORDER)
    return folded(codes), lengths


def _slices(texts: list[bytes]) -> Iterator[list[int]]:
    rows: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if rows and size + len(text) > SLICE_BYTES:
            yield rows
            rows, size = [], 0
        rows.append(i)
        size += len(text)
    if rows:
        yield rows


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def byte_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code, n`` of the n-grams of bytes over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # The first arrays are summed; those that came since are added when they are as many.
        codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(0).to_pylist()]
            for rows in _slices(texts):
                new, n = np.unique(byte_codes([texts[i] for i in rows])[0], return_counts=True)
                codes.append(new)
                counts.append(n)
                if sum(map(len, codes[1:])) <= len(codes[0]):
                    continue
                summed = _summed(np.concatenate(codes), np.concatenate(counts))
                codes[:], counts[:] = [summed[0]], [summed[1]]
                if len(codes[0]) > COUNTED_GRAMS:
                    yield {"code": codes[0], "n": counts[0]}
                    codes[0], counts[0] = codes[0][:0], counts[0][:0]
        codes, counts = _summed(np.concatenate(codes), np.concatenate(counts))
        yield {"code": codes, "n": counts}

    found = map_batches(docs.select(text), "code bigint, n bigint", work)
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def class_counts(counts: DataFrame) -> DataFrame:
    """``code, n`` of the n-grams of classes from those of bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            codes = folded(batch.column(0).to_numpy())
            found, n = _summed(codes, batch.column(1).to_numpy())
            yield {"code": found.astype(np.int64), "n": n}

    found = map_batches(counts.select("code", "n"), "code bigint, n bigint", work)
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code, n`` of the n-grams of classes over all texts."""
    return class_counts(byte_counts(docs, text))


def _discounts(counts: DataFrame) -> list[float]:
    """What to take off counts of 1, 2, and 3 or more, from how many n-grams have 1, 2, 3, 4.

    Where these are too few for the formula, ``FALLBACK``.
    """
    of = {
        row["n"]: row["grams"]
        for row in counts.filter("n <= 4").groupBy("n").agg(F.count("*").alias("grams")).collect()
    }
    if not all(of.get(i) for i in (1, 2, 3)):
        return list(FALLBACK)
    share = of[1] / (of[1] + 2 * of[2])
    exact = [i - (i + 1) * share * of.get(i + 1, 0) / of[i] for i in (1, 2, 3)]
    return [d if 0 <= d <= i else f for i, d, f in zip((1, 2, 3), exact, FALLBACK, strict=True)]


def _taken(counts: DataFrame) -> Column:
    one, two, more = _discounts(counts)
    return F.when(F.col("n") == 1, F.lit(one)).when(F.col("n") == 2, F.lit(two)).otherwise(more)


def probabilities(spark, counts: DataFrame, staging: Staging) -> DataFrame:
    """``code, p`` for every code, by recursion over the orders; sums to 1 behind each context.

    The highest order counts occurrences, each lower one the distinct symbols before an n-gram.
    An order without any count hands the lower order's probabilities on.
    """
    orders = [staging.table(counts)]
    for size in range(ORDER - 1, 0, -1):
        lower = orders[-1].groupBy((F.col("code") % SYMBOLS**size).alias("code"))
        orders.append(staging.table(lower.agg(F.count("*").alias("n"))))
    table = spark.range(1).select(F.lit(0).cast("long").alias("code"), F.lit(1 / SYMBOLS).alias("p"))
    for size, found in zip(range(1, ORDER + 1), reversed(orders), strict=True):
        counted = found.withColumn("taken", _taken(found))
        contexts = counted.groupBy(F.floor(F.col("code") / SYMBOLS).alias("context")).agg(
            F.sum("n").alias("total"), F.sum("taken").alias("left")
        )
        codes = spark.range(SYMBOLS**size).select(
            F.col("id").alias("code"),
            F.floor(F.col("id") / SYMBOLS).alias("context"),
            (F.col("id") % SYMBOLS ** (size - 1) if size > 1 else F.lit(0)).alias("suffix"),
        )
        lower = table.select(F.col("code").alias("suffix"), F.col("p").alias("lower_p"))
        joined = (
            codes.join(counted, "code", "left").join(contexts, "context", "left")
            .join(lower, "suffix")
        )
        own = F.coalesce((F.col("n") - F.col("taken")) / F.col("total"), F.lit(0.0))
        weight = F.coalesce(F.col("left") / F.col("total"), F.lit(1.0))
        table = staging.table(joined.select("code", (own + weight * F.col("lower_p")).alias("p")))
    return table


def _key(code: Column, size: int) -> Column:
    return code + F.lit(size << KEY_SHIFT)


def byte_model(counts: DataFrame, staging: Staging) -> DataFrame:
    """``key, own, weight`` of every n-gram and every context of each order, sharded by key.

    ``own`` is an n-gram's own share of its context, ``weight`` the share that a context leaves to
    the next lower order.  Counts are of occurrences, below the highest order of distinct bytes
    before an n-gram.
    """
    orders = [counts]
    for size in range(BYTE_ORDER - 1, 0, -1):
        lower = orders[-1].groupBy((F.col("code") % 256**size).alias("code"))
        orders.append(staging.table(lower.agg(F.count("*").alias("n"))))
    none = F.lit(None).cast("float")
    rows = []
    for size, found in zip(range(1, BYTE_ORDER + 1), reversed(orders), strict=True):
        counted = found.withColumn("taken", _taken(found)).withColumn(
            "context", F.shiftright("code", 8)
        )
        contexts = counted.groupBy("context").agg(
            F.sum("n").alias("total"), F.sum("taken").alias("left")
        )
        own = ((F.col("n") - F.col("taken")) / F.col("total")).cast("float")
        weight = (F.col("left") / F.col("total")).cast("float")
        rows.append(
            counted.join(contexts.hint("merge"), "context").select(
                _key(F.col("code"), size).alias("key"), own.alias("own"), none.alias("weight")
            )
        )
        rows.append(
            contexts.select(
                _key(F.col("context"), size - 1).alias("key"),
                none.alias("own"),
                weight.alias("weight"),
            )
        )
    return (
        reduce(DataFrame.unionAll, rows)
        .groupBy("key")
        .agg(
            F.coalesce(F.max("own"), F.lit(0).cast("float")).alias("own"),
            F.coalesce(F.max("weight"), F.lit(1).cast("float")).alias("weight"),
        )
    )


def _base(table: DataFrame) -> np.ndarray:
    """The class model's probability of every code: ``SYMBOLS ** ORDER`` values."""
    rows = table.select(F.col("code").cast("int"), F.col("p").cast("float")).toArrow()
    out = np.zeros(SYMBOLS**ORDER, np.float32)
    out[rows["code"].to_numpy()] = rows["p"].to_numpy()
    return out


def _order_keys(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the n-grams of an order that end where the codes end, and of their contexts."""
    own = codes & ((1 << (8 * size)) - 1)
    return own + (size << KEY_SHIFT), (own >> 8) + ((size - 1) << KEY_SHIFT)


def _packed(docs: DataFrame, slices: int) -> DataFrame:
    """``slice, block``: the rows of ``docs`` by slice, as compressed Arrow."""
    key = F.xxhash64("text")
    asked = docs.select(
        F.pmod(F.xxhash64("doc_id", key), F.lit(slices)).cast("int").alias("slice"),
        "doc_id",
        "lang",
        key.alias("text_key"),
        "text",
    )

    def blocks(held: list[pa.RecordBatch]) -> Iterator[dict]:
        table = pa.Table.from_batches(held).sort_by("slice")
        of = table["slice"].to_numpy()
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        zstd = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
        for start, end in zip(starts, [*starts[1:], len(of)], strict=True):
            sink = pa.BufferOutputStream()
            part = table.slice(start, end - start).drop_columns("slice").combine_chunks()
            with pa.ipc.new_stream(sink, part.schema, options=zstd) as out:
                out.write_table(part)
            yield {"slice": [of[start]], "block": [sink.getvalue().to_pybytes()]}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > PACKED_BYTES:
                yield from blocks(held)
                held, size = [], 0
        if size:
            yield from blocks(held)

    return map_batches(asked, "slice int, block binary", work).repartition(slices, "slice")


def _chunks(block: pa.Buffer) -> Iterator[tuple[pa.Table, pa.Array, np.ndarray]]:
    """Parts of a block's rows with the n-grams that end at their bytes, and the texts' lengths."""
    table = pa.ipc.open_stream(block).read_all()
    texts = [(t or "").encode() for t in table["text"].to_pylist()]
    for rows in _slices(texts):
        codes, lengths = byte_codes([texts[i] for i in rows])
        yield table.slice(rows[0], len(rows)), pa.array(codes), lengths


def _asked(packed: DataFrame) -> DataFrame:
    """``slice, key``: the distinct n-grams and contexts of all orders of each slice."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # The first array of a slice is its distinct codes so far; those that came since are merged
        # when they are as many, so a code is sorted a few times only.
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for of, block in zip(*batch.columns, strict=True):
                for _, codes, _ in _chunks(block.as_buffer()):
                    held = seen.setdefault(of.as_py(), [])
                    held.append(codes.unique().to_numpy())
                    if sum(map(len, held[1:])) > len(held[0]):
                        held[:] = [np.unique(np.concatenate(held))]
        for of, held in seen.items():
            # The distinct n-grams of an order have all those of the lower ones in them.
            grams = np.unique(np.concatenate(held))
            held.clear()
            for size in range(BYTE_ORDER, -1, -1):
                keys = grams
                if size < BYTE_ORDER:
                    keys = grams >> 8
                    grams = np.unique(grams & ((1 << (8 * size)) - 1))
                    keys = np.union1d(keys, grams)
                for begin in range(0, len(keys), SENT_KEYS):
                    sent = keys[begin : begin + SENT_KEYS] + (size << KEY_SHIFT)
                    yield {"slice": np.full(len(sent), of, np.int32), "key": sent}

    return map_batches(packed, "slice int, key bigint", work)


def score(docs: DataFrame, model: DataFrame, base: np.ndarray) -> DataFrame:
    """``doc_id, lang, text_key, perplexity`` (per byte; null without text)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = _packed(docs, max(LEAST_SLICES, -(-size // JOINED_BYTES)))
    found = _asked(packed).join(model.hint("merge"), "key")
    classes = spark.sparkContext.broadcast(base)

    def chances(codes: np.ndarray, keys: np.ndarray, own: np.ndarray, weight: np.ndarray):
        def known(asked: np.ndarray, values: np.ndarray, other: float) -> np.ndarray:
            if not len(keys):
                return np.full(len(asked), other)
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            return np.where(keys[at] == asked, values[at], other)

        p = classes.value[folded(codes)] / CLASS_BYTES[CLASSES[codes & 255]]
        for order in range(1, BYTE_ORDER + 1):
            grams, contexts = _order_keys(codes, order)
            p = known(grams, own, 0.0) + known(contexts, weight, 1.0) * p
        return p

    def work(blocks: pa.Table, hits: pa.Table) -> pa.Table:
        by_key = np.argsort(hits["key"].to_numpy())
        table = [hits[name].to_numpy()[by_key] for name in ("key", "own", "weight")]
        out = []
        give_back()
        # The slice's n-grams so far in order, and the bits of each.
        seen, bits = np.zeros(0, np.int64), np.zeros(0)
        for block in blocks["block"]:
            for rows, codes, lengths in _chunks(block.as_buffer()):
                coded = codes.dictionary_encode()
                distinct = coded.dictionary.to_numpy()
                order = np.argsort(distinct)
                asked = distinct[order]
                at = np.searchsorted(seen, asked)
                fresh = np.append(seen, -1)[at] != asked
                new = asked[fresh]
                more = -np.log2(np.maximum(chances(new, *table), 1e-12))
                seen, bits = np.insert(seen, at[fresh], new), np.insert(bits, at[fresh], more)
                cost = np.empty(len(distinct))
                cost[order] = bits[np.searchsorted(seen, asked)]
                place = coded.indices.to_numpy()
                perplexity = np.full(len(lengths), np.nan)
                filled = np.flatnonzero(lengths)
                if len(filled):
                    starts = (np.cumsum(lengths) - lengths)[filled]
                    sums = np.add.reduceat(cost[place], starts)
                    perplexity[filled] = np.exp2(sums / lengths[filled])
                values = pa.array(perplexity, from_pandas=True)
                out.append(rows.drop_columns("text").append_column("perplexity", values))
        if out:
            return pa.concat_tables(out)
        return pa.table({name: pa.array([], kind) for name, kind in scored})

    scored = [("doc_id", pa.int64()), ("lang", pa.string())]
    scored += [("text_key", pa.int64()), ("perplexity", pa.float64())]
    return (
        packed.groupBy("slice")
        .cogroup(found.groupBy("slice"))
        .applyInArrow(work, "doc_id bigint, lang string, text_key bigint, perplexity double")
    )


def _trusted(labels: DataFrame) -> DataFrame:
    """Ids that some label calls good and none calls bad, with their fold."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
        .filter("good")
        .select(
            "doc_id",
            (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == CALIBRATION).alias(
                "calibration"
            ),
        )
    )


def learnt_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id, text`` of the trusted documents that are learnt from.

    A filter of fixed size lets few other texts through before the join by id.
    """
    ids = trusted.filter("NOT calibration").select("doc_id")
    maybe = BitFilter(ids, "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            kept = pa.array(maybe.holds(batch.column(0).fill_null(0).to_numpy()))
            yield {"doc_id": batch.column(0).filter(kept), "text": batch.column(1).filter(kept)}

    texts = map_batches(docs.select("doc_id", "text"), "doc_id bigint, text string", work)
    return texts.join(ids.hint("merge"), "doc_id", "left_semi")


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, float]:
    """``lang, most``: the largest perplexity to keep by language, and the one for all others."""
    at = F.percentile_approx("perplexity", quantile, 10_000).alias("most")
    known = scored.filter(F.col("perplexity").isNotNull())
    by_language = (
        known.filter(F.col("lang").isNotNull())
        .groupBy("lang")
        .agg(at, F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_CALIBRATION)
        .select("lang", "most")
    )
    overall = known.agg(at).first()["most"]
    return by_language, float("inf") if overall is None else overall


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, text_key, perplexity, threshold, kept`` per row of ``docs``.

    Kept are texts whose perplexity is at most the threshold of their language.  A null or empty
    text has no perplexity and is not kept.  A null or rarely labelled language takes the threshold
    of all languages.  Without trusted documents every text is kept that is not empty.  Repeated
    labels agree or do not trust; repeated rows are answered each; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "lang")
    staging = Staging(spark)
    trusted = staging.table(_trusted(labels))
    counts = staging.table(byte_counts(learnt_texts(docs, trusted)))
    table = probabilities(spark, class_counts(counts), staging)
    give_back_driver(spark)
    base = _base(table)
    give_back_driver(spark)
    scored = staging.table(score(docs, staging.table(byte_model(counts, staging)), base))
    calibration = trusted.filter("calibration").select("doc_id")
    by_language, overall = thresholds(scored.join(calibration, "doc_id", "left_semi"), quantile)
    # A written table, whose size decides whether it is broadcast.
    limits = staging.table(by_language)
    return (
        scored.join(limits, "lang", "left")
        .withColumn("threshold", F.coalesce("most", F.lit(overall)))
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
        .select(*scored.columns, "threshold", "kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The rejected rows' keys, a small share, are what the documents are joined with.
    """
    bad = (
        classify(docs, labels, quantile)
        .filter("NOT kept")
        .select(F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_key"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(bad["__bad_id"]) & (
        F.xxhash64(docs["text"]) == bad["__bad_key"]
    )
    return docs.join(bad.hint("merge"), same, "left_anti")
