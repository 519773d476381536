"""Removal of repeated 100-byte strings with a run-length index.

Which windows of ``WINDOW`` bytes could repeat is found by content: a window's anchor is the least
hash of its ``ANCHOR``-byte strings, the leftmost of equal ones, so equal windows have equal anchors
at equal offsets.  A stretch of windows with one anchor and the bytes they cover is its context.
A count of anchors and of hashes of their contexts over the corpus tells four kinds: anchors that
occur once are left out; where all contexts are equal, all but the first are repeats as a whole and
only places are sent; where they differ, contexts are sent; and where very many differ, so that one
task could not gather them, each window is sent by its hash.  All meet by key, ordered by place.

Anchors are long, as those of a few words recur by chance, ever more of them in a larger corpus, and
their contexts would be compared for nothing.  Of the contexts of an anchor only the windows go on
whose half around it, from the left or to the right, another context has too: the others have no
equal.

The contexts left of some anchors become one text for a run-length index: its Burrows-Wheeler
transform is cut into runs of equal bytes, and the suffixes at the runs' starts are sampled, with
the suffix before each and the length they share.  Away from the samples both follow: going one
byte on in the text shortens the shared length by one and moves both suffixes by one.  So the
matching statistics stream from the samples alone, and chains of matches of ``WINDOW`` bytes lead
from each window to its equals, the first of which stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.arrow import map_batches
from sluicework.llm.bit_filter import BitFilter
from sluicework.llm.columns import same_row, text_key
from sluicework.llm.shingle_join import signed
from sluicework.sources.storage import Staging, shuffles_dropped

# Fixed value of the contract.
WINDOW = 100

ANCHOR = 32
# Bytes beside the anchor that each window has on its left or on its right.
BESIDE = (WINDOW - ANCHOR) // 2
SLICE_BYTES = 2 << 20
CACHED_BYTES = 64 << 10
# Bytes of context taken at once and per index (which a processor's cache holds best), and
# occurrences of one anchor beyond which windows go by hash.
TAKEN_BYTES = 1 << 20
INDEX_BYTES = 64 << 10
GROUP_CONTEXTS = 20_000
PACKED = 8
# Rows of windows sent at once.
SENT_WINDOWS = 10_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    """The first ``2 ** bits`` powers, modulo 2 to the 64."""
    out = np.ones(1 << bits, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number."""
    return np.ndarray((max(0, len(raw) - 7),), "<u8", np.ascontiguousarray(raw), strides=(1,))


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from every place on, by doubling from eight."""
    now = _words(raw) * np.uint64(_BASE)
    now ^= now >> np.uint64(29)
    size = 8
    factor = 0xC2B2AE3D27D4EB4F
    while size < ANCHOR:
        now = now[:-size] * np.uint64(factor) + now[size:]
        now ^= now >> np.uint64(29)
        factor = (factor * 0xD6E8FEB86659FD93 | 1) & 0xFFFFFFFFFFFFFFFF
        size *= 2
    now *= np.uint64(0xBF58476D1CE4E5B9)
    now ^= now >> np.uint64(32)
    return now


class Stretches(NamedTuple):
    """Stretches of windows with one anchor, of several texts: the text's number, the anchor's
    hash, a hash of the context, first and last window and the anchor's place within the text."""

    text: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray


def stretches(texts: list[bytes]) -> Stretches:
    """The stretches of all texts, found for as many at a time as a processor's cache holds."""
    parts, begin, size = [], 0, 0
    for end, text in enumerate(texts, 1):
        size += len(text)
        if size >= CACHED_BYTES or end == len(texts):
            part = _stretches(texts[begin:end])
            parts.append(part._replace(text=part.text + begin))
            begin, size = end, 0
    return Stretches(*map(np.concatenate, zip(*parts, strict=True))) if parts else _stretches([])


def _stretches(texts: list[bytes]) -> Stretches:
    """A text of fewer bytes than a window has none."""
    none = np.zeros(0, np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    count = len(raw) - WINDOW + 1
    if count <= 0:
        return Stretches(none, none, none, none, none, none)
    ends = np.cumsum([len(t) for t in texts])
    begins = np.r_[0, ends[:-1]]
    hashes = _hashes(raw)
    span = WINDOW - ANCHOR + 1
    # High bits of the hash decide, then the place, so the least value tells the leftmost place.
    high = np.uint64(0xFFFFFFFF00000000)
    least, size = hashes & high | np.arange(len(hashes), dtype=np.uint64), 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:count], least[span - size : span - size + count])
    place = (least[:count] & ~high).astype(np.int64)
    # Only windows within one text count: those across its end get no place.
    for begin, end in zip(np.maximum(begins, ends - WINDOW + 1), ends, strict=True):
        place[begin:end] = -1
    # A text's last window is its own, so stretches of two texts never touch.
    change = np.flatnonzero(place[1:] != place[:-1])
    head, tail = np.r_[0, change + 1], np.r_[change, count - 1]
    whole = place[head] >= 0
    first, last = head[whole], tail[whole]
    at = place[first]
    text = np.searchsorted(ends, first, side="right")
    # A polynomial over the hashes of all places of the context, moved back to its start.
    bits = max(20, len(hashes).bit_length())
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, bits)[: len(hashes)], dtype=np.uint64, out=sums[1:])
    context = (sums[last + span] - sums[first]) * _powers(_INVERSE, bits)[first]
    context ^= (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    begin = begins[text]
    return Stretches(
        text, signed(hashes[at]), signed(context), first - begin, last - begin, at - begin
    )


def _suffix_array(text: np.ndarray, breaks: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols; ``breaks`` are symbols of their own."""
    rank = text.astype(np.int64) + len(breaks)
    rank[breaks] = np.arange(len(breaks))
    bits = int(rank.max() + 1).bit_length()
    size = max(1, min(PACKED, 62 // bits))
    key = rank + 1
    for k in range(1, size):
        key <<= bits
        key[: len(rank) - k] += rank[k:] + 1
    order = np.argsort(key)
    ordered, spots = key[order], np.arange(len(order))
    while True:
        # The rank is the first spot of the suffixes that are still equal; only they are sorted on.
        fresh = np.r_[True, ordered[1:] != ordered[:-1]]
        rank[order[spots]] = spots[np.maximum.accumulate(np.where(fresh, np.arange(len(spots)), 0))]
        spots = spots[~(fresh & np.r_[fresh[1:], True])]
        if size >= depth or not len(spots):
            return order
        equal = order[spots]
        key = rank[equal] * np.int64(len(rank) + 1)
        inside = equal + size < len(rank)
        key[inside] += rank[equal[inside] + size] + 1
        by_key = np.argsort(key)
        order[spots], ordered = equal[by_key], key[by_key]
        size *= 2


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform, sampled at their starts.

    ``text`` holds contexts, each ended by a break that matches nothing.  ``sample`` are the text
    places of the suffixes at run starts, ascending; ``before`` and ``shared`` their neighbour in
    suffix order and how many bytes they share.
    """

    def __init__(self, text: np.ndarray, breaks: np.ndarray, depth: int) -> None:
        order = _suffix_array(text, breaks, depth)
        broken = np.zeros(len(text), bool)
        broken[breaks] = True
        last = text[order - 1].astype(np.int16)
        last[broken[order - 1]] = -1
        # A break before a suffix ends a run: what stands before it is no part of a match.
        heads = np.flatnonzero(
            np.r_[True, (last[1:] != last[:-1]) | (last[1:] < 0)]
        )
        self.run_bytes, self.run_starts = last[heads], heads
        place = order[heads]
        neighbour = np.where(heads > 0, order[heads - 1], -1)
        shared = self._common(text, breaks, place, neighbour)
        by_place = np.argsort(place)
        self.sample, self.before, self.shared = (
            x[by_place] for x in (place, neighbour, shared)
        )
        self.size = len(text)

    @staticmethod
    def _common(
        text: np.ndarray, breaks: np.ndarray, a: np.ndarray, b: np.ndarray
    ) -> np.ndarray:
        """Bytes that two places share before the next break of either, eight at a time."""
        padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
        eight = np.zeros(len(text), np.uint64)
        for k in range(8):
            eight |= padded[k : k + len(text)] << np.uint64(8 * k)
        to_break = breaks[np.searchsorted(breaks, np.arange(len(text)))] - np.arange(len(text))
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        limit = np.zeros(len(a), np.int64)
        limit[live] = np.minimum(to_break[a[live]], to_break[b[live]])
        live = live[limit[live] > 0]
        while len(live):
            differ = eight[a[live] + out[live]] ^ eight[b[live] + out[live]]
            lowest = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) // 8)
            out[live] = np.minimum(out[live] + equal, limit[live])
            live = live[(equal == 8) & (out[live] < limit[live])]
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Per text place how long it matches its neighbour in suffix order, and that neighbour."""
        places = np.arange(self.size)
        at = np.searchsorted(self.sample, places, side="right") - 1
        gone = places - self.sample[at]
        length = np.where(self.before[at] >= 0, self.shared[at] - gone, 0)
        return np.maximum(length, 0), self.before[at] + gone


def repeated_windows(contexts: list[bytes], first: int = WINDOW) -> list[np.ndarray]:
    """Per context the windows (by offset) that an earlier context, or place, has too."""
    if not contexts:
        return []
    text = np.frombuffer(b"\0".join([*contexts, b""]), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    breaks = np.cumsum(sizes + 1) - 1
    depth = int(sizes.max()) + 1
    index = RunLengthIndex(text, breaks, depth)
    length, neighbour = index.statistics()
    long = length >= first
    head = np.where(long, neighbour, np.arange(len(text)))
    while True:  # every chain of long matches ends at its first suffix in order
        further = head[head]
        if (further == head).all():
            break
        head = further
    least = np.arange(len(text))
    np.minimum.at(least, head, np.arange(len(text)))
    again = least[head] < np.arange(len(text))
    starts = np.r_[0, breaks[:-1] + 1]
    return [np.flatnonzero(again[s : s + n]) for s, n in zip(starts, sizes, strict=True)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(), "text")


def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows of about ``SLICE_BYTES`` and their bytes."""
    rows: list[int] = []
    raw: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        rows.append(i)
        raw.append((text or "").encode())
        size += len(raw[-1])
        if size >= SLICE_BYTES:
            yield rows, raw
            rows, raw, size = [], [], 0
    if rows:
        yield rows, raw


def anchor_counts(docs: DataFrame) -> DataFrame:
    """``anchor, times, least, most``: how often each anchor starts a stretch, and the ends of its
    contexts' hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for _, raw in _slices(batch.column(0).to_pylist()):
                found = stretches(raw)
                order = np.argsort(found.anchor, kind="stable")
                anchor, context = found.anchor[order], found.context[order]
                head = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]][: len(anchor)])
                if len(head):
                    yield {
                        "anchor": anchor[head],
                        "times": np.diff(np.r_[head, len(anchor)]).astype(np.int32),
                        "least": np.minimum.reduceat(context, head),
                        "most": np.maximum.reduceat(context, head),
                    }

    rows = map_batches(
        _texts(docs).select("text"), "anchor bigint, times int, least bigint, most bigint", work
    )
    return rows.groupBy("anchor").agg(
        F.sum("times").alias("times"), F.min("least").alias("least"), F.max("most").alias("most")
    )


_PLACES = "key bigint, more bigint, doc_id bigint, text_key bigint, first int, last int"


def _merged(
    doc: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (in order of text and place) that follow each other as one."""
    joins = (doc[1:] == doc[:-1]) & (first[1:] == last[:-1] + 1)
    head = np.flatnonzero(np.r_[True, ~joins][: len(doc)])
    tail = np.r_[head[1:] - 1, len(doc) - 1][: len(head)]
    return doc[head], first[head], last[tail]


def occurrences(
    docs: DataFrame, repeated: BitFilter, differing: BitFilter, crowded: BitFilter
) -> DataFrame:
    """``key, more, doc_id, text_key, first, last, at, context``: places to compare, by kind; a
    context comes with its anchor's place in it, ``at``.

    Of stretches with equal contexts in a slice only the first is sent; the others come as known
    repeats, without a key.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column(0)
            null = np.array(ids.is_null())
            low = ids.fill_null(-(1 << 63)).to_numpy()
            keys = batch.column(1).to_numpy()
            for rows, raw in _slices(batch.column(2).to_pylist()):
                rows = np.array(rows)
                found = stretches(raw)
                if len(found.anchor):
                    kept = repeated.holds(found.anchor)
                    found = Stretches(*(x[kept] for x in found))
                if not len(found.anchor):
                    continue
                row = rows[found.text]
                order = np.lexsort((found.first, low[row], found.context, found.anchor))
                equal = np.zeros(len(order), bool)
                before, after = order[:-1], order[1:]
                equal[after] = (
                    (found.anchor[after] == found.anchor[before])
                    & (found.context[after] == found.context[before])
                )
                same_place = np.zeros(len(order), bool)
                same_place[after] = (low[row[after]] == low[row[before]]) & (
                    found.first[after] == found.first[before]
                )
                known = np.flatnonzero(equal & ~same_place)
                # Equal rows stand at one place: neither repeats the other, if the first does not.
                sent = np.flatnonzero(~equal | same_place)
                text, first, last = _merged(found.text[known], found.first[known], found.last[known])
                at = rows[text]
                yield {
                    "key": pa.nulls(len(at), pa.int64()),
                    "more": pa.nulls(len(at), pa.int64()),
                    "doc_id": pa.array(low[at], mask=null[at]),
                    "text_key": keys[at],
                    "first": first,
                    "last": last,
                    "at": pa.nulls(len(at), pa.int32()),
                    "context": pa.nulls(len(at), pa.binary()),
                }
                anchor = found.anchor[sent]
                many = crowded.holds(anchor)
                differ = differing.holds(anchor)[~many]
                plain = sent[~many]
                at = row[plain]
                spots = zip(found.text[plain], found.first[plain], found.last[plain], strict=True)
                yield {
                    "key": found.anchor[plain],
                    "more": np.zeros(len(plain), np.int64),
                    "doc_id": pa.array(low[at], mask=null[at]),
                    "text_key": keys[at],
                    "first": found.first[plain],
                    "last": found.last[plain],
                    "at": pa.array(found.place[plain] - found.first[plain], mask=~differ),
                    "context": [
                        raw[t][a : b + WINDOW] if d else None
                        for (t, a, b), d in zip(spots, differ, strict=True)
                    ],
                }
                crowd = sent[many]
                sizes = found.last[crowd] - found.first[crowd] + 1
                parts = np.cumsum(sizes) // SENT_WINDOWS
                for part in np.split(crowd, np.flatnonzero(np.diff(parts)) + 1):
                    if not len(part):
                        continue
                    spots = zip(found.text[part], found.first[part], found.last[part], strict=True)
                    digests = [
                        xxhash.xxh3_128_digest(raw[t][k : k + WINDOW])
                        for t, a, b in spots
                        for k in range(a, b + 1)
                    ]
                    halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64)
                    size = found.last[part] - found.first[part] + 1
                    at = np.repeat(row[part], size)
                    first = np.arange(len(at)) + np.repeat(
                        found.first[part] - np.cumsum(size) + size, size
                    )
                    yield {
                        "key": halves[::2],
                        "more": halves[1::2],
                        "doc_id": pa.array(low[at], mask=null[at]),
                        "text_key": keys[at],
                        "first": first,
                        "last": first,
                        "at": pa.nulls(len(at), pa.int32()),
                        "context": pa.nulls(len(at), pa.binary()),
                    }

    return map_batches(_texts(docs), f"{_PLACES}, at int, context binary", work)


def _plain_repeats(columns: list[np.ndarray], head: np.ndarray | None) -> tuple:
    """Of sorted places (key, more, id, place) which repeat the first of their key; and the first
    of the last key, which the next call takes as ``head``."""
    with_head = [
        c if head is None else np.concatenate([h, c])
        for c, h in zip(columns, head or [None] * 4, strict=True)
    ]
    key, more, doc, place = with_head
    fresh = np.r_[True, (key[1:] != key[:-1]) | (more[1:] != more[:-1])]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    again = (doc != doc[first]) | (place != place[first])
    last = first[-1]
    return again[0 if head is None else 1 :], [c[last : last + 1] for c in with_head]


def _shared(group: np.ndarray, side: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which contexts (of those ``there``) have a side that another of their group has."""
    rows = np.flatnonzero(there)
    order = rows[np.lexsort((side[rows], group[rows]))]
    same = (group[order[1:]] == group[order[:-1]]) & (side[order[1:]] == side[order[:-1]])
    out = np.zeros(len(group), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _sides(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of the anchor and the bytes beside it, from each place on."""
    words, size = _words(data), ANCHOR + BESIDE
    out = np.zeros(len(begin), np.uint64)
    for k in (*range(0, size - 8, 8), size - 8):
        out = (out ^ words[begin + k]) * np.uint64(_BASE)
        out ^= out >> np.uint64(32)
    return out


def _context_repeats(batch: pa.RecordBatch) -> dict:
    """``doc_id, text_key, first, last`` of windows that repeat, of whole groups of contexts."""
    key, more, first, last, at = (
        batch.column(n).to_numpy().astype(np.int64) for n in ("key", "more", "first", "last", "at")
    )
    ids, contexts = batch.column("doc_id"), batch.column("context").cast(pa.binary())
    null, low = np.array(ids.is_null()), ids.fill_null(0).to_numpy()
    group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (more[1:] != more[:-1])])
    code = contexts.dictionary_encode().indices.to_numpy()
    order = np.lexsort((code, group))  # leaves equal contexts in order of place
    fresh = np.r_[
        True, (group[order[1:]] != group[order[:-1]]) | (code[order[1:]] != code[order[:-1]])
    ]
    earliest = np.empty(len(order), np.int64)
    earliest[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    again = np.flatnonzero(
        (null != null[earliest]) | (low != low[earliest]) | (first != first[earliest])
    )
    found = [(again, first[again], last[again])]

    # Windows of one context have their anchor at different offsets, so none are equal; two windows
    # can be only where their contexts share the bytes from the anchor to the left or to the right.
    data = np.frombuffer(contexts.buffers()[2], np.uint8)
    begin = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset :][: len(contexts)]
    own = np.sort(order[fresh])
    to_anchor, windows = at[own], last[own] - first[own] + 1
    middle = np.clip(to_anchor - BESIDE + 1, 0, windows)  # the first window that has the right side
    anchor = begin[own].astype(np.int64) + to_anchor
    left_there, right_there = middle > 0, middle < windows
    left = _shared(group[own], _sides(data, anchor - BESIDE * left_there), left_there)
    right_begin = np.where(right_there, anchor, begin[own])
    right = _shared(group[own], _sides(data, right_begin), right_there)
    low_end = np.where(left, 0, middle)
    high_end = np.where(right, windows, middle)
    chosen = np.flatnonzero(low_end < high_end)
    rows, low_end, high_end = own[chosen], low_end[chosen], high_end[chosen]
    start, stop = begin[rows] + low_end, begin[rows] + high_end + WINDOW - 1
    # Groups are indexed together, but each as a whole.
    ends = np.flatnonzero(np.r_[group[rows][1:] != group[rows][:-1], True][: len(rows)])
    filled = np.cumsum(stop - start)[ends] // INDEX_BYTES
    cuts = ends[np.flatnonzero(np.diff(filled))] + 1
    for part in np.split(np.arange(len(rows)), cuts):
        texts = [data[a:b].tobytes() for a, b in zip(start[part], stop[part], strict=True)]
        which, again = _flat(repeated_windows(texts))
        if len(which):
            row = rows[part][which]
            place = first[row] + low_end[part][which] + again
            found.append(_merged(row, place, place))
    row, first, last = map(np.concatenate, zip(*found, strict=True))
    chosen = batch.select(["doc_id", "text_key"]).take(pa.array(row))
    return {
        "doc_id": chosen.column(0), "text_key": chosen.column(1), "first": first, "last": last,
    }


def _flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the parts that the values stand in, and the values."""
    which = np.repeat(np.arange(len(parts)), np.array([len(p) for p in parts], np.int64))
    return which, np.concatenate([*parts, np.zeros(0, np.int64)])


class _Groups:
    """Gathers sorted contexts until there are enough of whole groups."""

    def __init__(self) -> None:
        self._waiting: list[pa.RecordBatch] = []
        self._size = 0

    def take(self, batch: pa.RecordBatch) -> Iterator[dict]:
        self._waiting.append(batch)
        self._size += pc.sum(pc.binary_length(batch.column("context"))).as_py()
        if self._size < TAKEN_BYTES:
            return
        # The last group may go on in the next batch.
        whole = pa.concat_batches(self._waiting)
        key, more = (whole.column(n).to_numpy() for n in ("key", "more"))
        before = np.flatnonzero((key != key[-1]) | (more != more[-1]))
        cut = before[-1] + 1 if len(before) else 0
        if cut:
            yield _context_repeats(whole.slice(0, cut))
        self._waiting, self._size = [whole.slice(cut)], 0

    def close(self) -> Iterator[dict]:
        if self._waiting:
            yield _context_repeats(pa.concat_batches(self._waiting))
        self._waiting = []


def repeats(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, first, last``: windows of the places that also start earlier.

    A key's places all come with a context, or all without.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        groups, head = _Groups(), None
        for batch in batches:
            plain = np.array(batch.column("context").is_null())
            if plain.any():
                part = batch.filter(pa.array(plain))
                ids = part.column("doc_id")
                low = ids.fill_null(-(1 << 63)).to_numpy()
                numbers = [part.column(c).to_numpy() for c in ("key", "more")]
                first = part.column("first").to_numpy()
                again, head = _plain_repeats([*numbers, low, first], head)
                chosen = part.filter(pa.array(again))
                yield {n: chosen.column(n) for n in ("doc_id", "text_key", "first", "last")}
            if not plain.all():
                yield from groups.take(batch.filter(pa.array(~plain)))
        yield from groups.close()

    ordered = found.repartition("key", "more").sortWithinPartitions(
        "key", "more", "doc_id", "first", "text_key"
    )
    return map_batches(ordered, "doc_id bigint, text_key bigint, first int, last int", work)


def repeated_spans(docs: DataFrame, staging: Staging) -> DataFrame:
    """``doc_id, text_key, first, last``: stretches of windows that also start earlier."""
    with shuffles_dropped(docs.sparkSession):
        counts, seen = staging.measured_table(
            anchor_counts(docs).filter("times > 1"),
            repeated="count(*)",
            differing="count_if(least <> most)",
            crowded=f"count_if(least <> most AND times > {GROUP_CONTEXTS})",
        )
        differing = counts.filter("least <> most")
        filters = [
            BitFilter(frame, "anchor", seen[kind] or 0)
            for kind, frame in (
                ("repeated", counts),
                ("differing", differing),
                ("crowded", differing.filter(F.col("times") > GROUP_CONTEXTS)),
            )
        ]
        found = staging.table(occurrences(docs, *filters))
    known = found.filter("key IS NULL").select("doc_id", "text_key", "first", "last")
    return known.unionByName(repeats(found.filter("key IS NOT NULL")))


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the windows of ``spans``, the bytes removed and their stretches."""
    pieces, at, removed, stretches = [], 0, 0, 0
    for first, last in sorted(spans):
        end = last + WINDOW
        if first > at or not stretches:
            stretches += 1
            pieces.append(raw[at:first])
            removed += end - first
            at = end
        elif end > at:
            removed += end - at
            at = end
    pieces.append(raw[at:])
    return b"".join(pieces), removed, stretches


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, kept, n_bytes, n_removed, n_spans`` per row of ``docs``.

    ``kept`` are the bytes (UTF-8, perhaps cut inside a character) left of each whole text.  A byte
    goes when a ``WINDOW``-byte string that covers it also starts at a smaller id, or earlier in
    the same document; strings are judged on the input.  A null text counts as empty, a null id
    comes before all others.  Rows with one id and different texts are told apart by their text and
    compared by place, then by the text's hash; equal rows are one document.  Other columns are
    ignored.
    """
    staging = Staging(docs.sparkSession)
    spans = repeated_spans(docs, staging)
    by_text = spans.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")
    )

    texts = _texts(docs)
    joined = texts.join(by_text.hint("merge"), same_row(texts, by_text), "left").select(
        texts["doc_id"], texts["text_key"], "text", "spans.first", "spans.last"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)
            done = []
            for text, first, last in rows:
                raw = (text or "").encode()
                spans = list(zip(first or (), last or (), strict=True))
                done.append((*kept_bytes(raw, spans), len(raw)))
            kept, removed, stretches, sizes = zip(*done, strict=True) if done else [[]] * 4
            yield {
                "doc_id": batch.column(0),
                "text_key": batch.column(1),
                "kept": kept,
                "n_bytes": sizes,
                "n_removed": removed,
                "n_spans": stretches,
            }

    return map_batches(
        joined,
        "doc_id bigint, text_key bigint, kept binary, n_bytes bigint, n_removed bigint,"
        " n_spans bigint",
        cut,
    )


def digest(removed: DataFrame) -> DataFrame:
    """``remove_repeats`` with the kept bytes as a SHA-256 digest."""
    return removed.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

