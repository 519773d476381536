"""Language identification by prediction by partial matching.

Per language a tree of byte contexts up to ``ORDER`` bytes holds the counts of what followed.  A
byte's probability comes from the longest context that has seen it, times the escape probability of
each longer context: with ``n`` bytes seen behind a context, ``q`` of them distinct, a seen byte
has ``count / (n + q)`` and the escape ``q / (n + q)``; below all contexts every byte has 1/256.
The counts are frozen after learning, so a text's code length is the sum of its bytes' costs, and
the language with the shortest code is predicted.

Learning counts a bounded sample of labelled rows (``SAMPLE`` per language), so the trees are
bounded and go to every task.  Scoring scans the documents once, without a shuffle: the distinct
contexts of a slice are costed in arrays, and a worker keeps up to ``COSTS_KEPT`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.arrow import map_batches

# Fixed values of the contract: the fold that is never learnt from.
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"

ORDER = 4
# Labelled rows per language that are learnt from, and the most languages.
SAMPLE = 400
MOST_LANGUAGES = 400
COSTS_KEPT = 1_500_000
SLICE_BYTES = 4 << 20


class Tree(NamedTuple):
    """One language's counts; entry ``k`` of each list is for contexts of ``k`` bytes."""

    grams: list[np.ndarray]  # context and byte as one number, ascending
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    distinct: list[np.ndarray]


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the ``ORDER`` before it as a number, and each text's length in bytes.

    Before a text stand zero bytes, so no context reaches into another text.
    """
    pad = bytes(ORDER)
    raw = np.frombuffer(pad.join([b"", *texts]), np.uint8).astype(np.uint64)
    codes = raw[ORDER:].copy()
    for back in range(1, ORDER + 1):
        codes |= raw[ORDER - back : len(raw) - back] << np.uint64(8 * back)
    lengths = np.array([len(t) for t in texts], np.int64)
    keep = np.ones(len(codes), bool)
    ends = np.cumsum(lengths + ORDER)[:-1]
    for k in range(ORDER):
        keep[ends - ORDER + k] = False
    return codes[keep], lengths


def _mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def tree(grams: np.ndarray, counts: np.ndarray) -> Tree:
    """The context tree below distinct full-order grams and their counts."""
    out = Tree([], [], [], [], [])
    for k in range(ORDER + 1):
        own, where = np.unique(grams & _mask(k + 1), return_inverse=True)
        seen = np.bincount(where, counts, len(own))
        above, first = np.unique(own >> np.uint64(8), return_inverse=True)
        out.grams.append(own)
        out.counts.append(seen)
        out.contexts.append(above)
        out.totals.append(np.bincount(first, seen, len(above)))
        out.distinct.append(np.bincount(first, minlength=len(above)).astype(float))
    return out


def costs(model: Tree, codes: np.ndarray) -> np.ndarray:
    """Bits of each gram's last byte behind the others."""
    chance = np.full(len(codes), 1 / 256)
    for k in range(ORDER + 1):
        own = codes & _mask(k + 1)
        count = _found(model.grams[k], model.counts[k], own)
        above = own >> np.uint64(8)
        total = _found(model.contexts[k], model.totals[k], above)
        distinct = _found(model.contexts[k], model.distinct[k], above)
        both = np.maximum(total + distinct, 1)
        escaped = np.where(total > 0, chance * distinct / both, chance)
        chance = np.where(count > 0, count / both, escaped)
    return -np.log2(chance)


class Scorer:
    """Code lengths of texts under every language; remembers the costs of grams it has met."""

    def __init__(self, trees: list[Tree]) -> None:
        self._trees = trees
        self._clear()

    def _clear(self) -> None:
        self._known = np.zeros(0, np.uint64)
        self._costs = np.zeros((0, len(self._trees)), np.float32)

    def _lookup(self, grams: np.ndarray) -> np.ndarray:
        """Costs of ascending distinct grams, a column per language."""
        if len(self._known) + len(grams) > COSTS_KEPT:
            self._clear()
        new = np.setdiff1d(grams, self._known, assume_unique=True)
        if len(new):
            found = np.stack([costs(t, new) for t in self._trees], 1).astype(np.float32)
            at = np.searchsorted(self._known, new)
            self._known = np.insert(self._known, at, new)
            self._costs = np.insert(self._costs, at, found, 0)
        return self._costs[np.searchsorted(self._known, grams)]

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits per text (row) and language (column)."""
        out = np.zeros((len(texts), len(self._trees)))
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= SLICE_BYTES):
                size += len(texts[end])
                end += 1
            codes, sizes = gram_codes(texts[begin:end])
            if len(codes):
                grams, where = np.unique(codes, return_inverse=True)
                table = self._lookup(grams)
                filled = np.flatnonzero(sizes)
                starts = (np.cumsum(sizes) - sizes)[filled]
                for j in range(len(self._trees)):
                    bits = table[:, j][where].astype(float)
                    out[begin + filled, j] = np.add.reduceat(bits, starts)
            begin = end
        return out


def _fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[Tree]]:
    """The languages in order and their trees, from at most ``sample`` rows of each.

    Learnt from are rows with an id outside the held-out fold, a language and a text with a letter;
    the sample is the rows whose ids hash lowest, so it does not depend on partitioning.
    """
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = (
        docs.filter((_fold() != HELD_OUT) & F.col("lang").isNotNull())
        .filter(F.rlike("text", F.lit(r"\p{L}")))
        .select("lang", "doc_id", F.xxhash64("doc_id", F.lit("sample")).alias("place"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= sample)
        .select("lang", "doc_id")
        .distinct()
    )
    texts = docs.select("lang", "doc_id", "text").join(
        F.broadcast(chosen), ["lang", "doc_id"], "left_semi"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = batch.to_pydict()
            for lang in sorted(set(rows["lang"])):
                own = [
                    (t or "").encode()
                    for t, of in zip(rows["text"], rows["lang"], strict=True)
                    if of == lang
                ]
                grams, n = np.unique(gram_codes(own)[0], return_counts=True)
                yield {"lang": [lang] * len(grams), "gram": grams.astype(np.int64), "n": n}

    found = (
        map_batches(texts, "lang string, gram bigint, n bigint", count)
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # Bounded by the sampled bytes.
    table = found.orderBy("lang", "gram").toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    grams = table["gram"].to_numpy().astype(np.uint64)
    counts = table["n"].to_numpy().astype(float)
    languages = sorted(set(names))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages, {MOST_LANGUAGES} are supported")
    return languages, [tree(grams[names == x], counts[names == x]) for x in languages]


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each whole text.

    ``score`` is the share of the predicted language when each language weighs 2 to the power of
    minus its code length.  ``und`` with score 0 where the text is null or has no letter, or where
    nothing could be learnt.  Equal code lengths go to the first language in order.  A null id is
    neither held out nor learnt from.  Predictions look at the text alone; rows that repeat are
    answered each; other columns are ignored.
    """
    languages, trees = learn(docs, sample)
    model = docs.sparkSession.sparkContext.broadcast((languages, trees))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names, known = model.value
        scorer = Scorer(known)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            told = [bool(t) and bool(names) and any(map(str.isalpha, t)) for t in texts]
            predicted = [UNDETERMINED] * len(texts)
            score = np.zeros(len(texts))
            rows = np.flatnonzero(told)
            if len(rows):
                bits = scorer.lengths([texts[i].encode() for i in rows])
                best = bits.argmin(1)
                shortest = bits.min(1, keepdims=True)
                score[rows] = 1 / np.exp2(np.maximum(shortest - bits, -1000.0)).sum(1)
                for i, j in zip(rows, best, strict=True):
                    predicted[i] = names[j]
            yield {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "lang_pred": predicted,
                "score": score,
            }

    asked = docs.select(
        "doc_id", F.coalesce(_fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text"
    )
    return map_batches(
        asked, "doc_id bigint, held_out boolean, lang_pred string, score double", work
    )
