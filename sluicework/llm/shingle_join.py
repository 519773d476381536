"""Exact Jaccard join of word shingles: size-banded tiles, bitmap bounds, exact intersections.

A document's set holds the hashes of its 5-word shingles.  Documents with one set are one node, so
copies take part once.  Two sets that reach the threshold share one of their first ``n - ceil(0.8
n) + 1`` shingles in any common order of shingles; the order puts shingles of many documents last,
and by hash otherwise.  Shingles that start in no two documents are dropped after a count.

Nodes that share a starting shingle are compared in one group, sorted by size and cut into tiles: a
tile of nodes meets only the tiles whose sizes can reach the threshold.  A bit of a node's bitmap
tells whether an odd number of its shingles fall on it; what two sets share cancels out, so there
are as many shingles in one set only as bits that differ, at least, which bounds the overlap from
above.  Pairs within the bound are verified by intersecting the sorted sets.  If the shared shingle is the first that two sets share, no more than what follows
it in either order is common, which spares the comparison in most other groups.

Near copies would pair with each other in great number, so links come in rounds.  The first rounds
look at the groups of each node's end shingles, the rarest and most common of its first ones: once
for one pair per node with a leader of the group, once for one pair per node and other component,
and once for all pairs of nodes of different components.  Of the groups that two nodes meet in, only
that of their least common end sends the pair.  The last round looks at all groups, and leaves out
pairs that were looked at before.  A row takes along the first few shingles of its node that come
before its own and meet others too, so a pair that shares one of them is not sent again.  A link
that no round looks at lies within a component, so no component is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.arrow import give_back_driver, map_batches, small
from sluicework.llm.bit_filter import BitFilter
from sluicework.llm.components import components
from sluicework.sources.storage import Staging, shuffles_dropped

# Fixed values of the contract.
WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5

# The most frequent shingles, so many and in so many documents at least, go to the end of the order;
# the order decides how much is compared, not what is linked.
COMMON_AT_LEAST = 8
COMMON_KEPT = 65_536
SHINGLES_AT_ONCE = 2_000_000
WORDS_KEPT = 200_000
# The rounds: whether they look at the groups of end shingles, ``ENDS`` from either side, or at all
# groups, and how many pairs a node sends: one with a leader, so many per other component, or all.
ENDS = 2
LEADERS = 0
ROUNDS = (("ends", LEADERS), ("ends", 1), ("ends", None), ("all", None))
TILE = 512
# Rows of a group that each row is compared with before bitmaps are sent.
NEIGHBOURS = 32
# Shingles before its own that a row takes along, the first ones of its node: sets near each other
# share one of them nearly always, and a pair that does not is sent from more groups than one.
BEFORE_KEPT = 6

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0x85EBCA77C2B2AE63],
    np.uint64,
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str | None, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct shingle hashes in ascending order; of a shorter text the hash of all words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(codes))
    count = len(codes) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed += codes[k : k + count] * _FACTORS[k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def node_of(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def text_of(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode()) - (1 << 63)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def prefix_size(n: int) -> int:
    return n + (-NUMERATOR * n // DENOMINATOR) + 1


def bitmap(found: np.ndarray) -> bytes:
    """One to two bits per shingle, a power of two; each shingle flips one of them."""
    bits = max(64, 1 << int(len(found) - 1).bit_length())
    out = np.zeros(bits // 8, np.uint8)
    at = (found & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_xor.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out.tobytes()


def _documents(docs: DataFrame) -> tuple[DataFrame, str]:
    return docs.select("doc_id", "text"), docs.schema["doc_id"].dataType.simpleString()


def read_sets(docs: DataFrame) -> DataFrame:
    """A row per document (``doc_id``, ``node``, ``n``, ``text_key``), and rows of shingles that
    are common in the documents of a task (``token``, ``times``)."""
    docs, kind = _documents(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = _WordHashes()
        waiting: list[np.ndarray] = []
        size = 0

        def common() -> dict:
            tokens, times = np.unique(np.concatenate(waiting), return_counts=True)
            many = times >= COMMON_AT_LEAST
            n = int(many.sum())
            waiting.clear()
            none = [None] * n
            return {
                "doc_id": none, "node": none, "n": none, "text_key": none,
                "token": signed(tokens[many]), "times": times[many],
            }

        for batch in small(batches):
            texts = batch.column(1).to_pylist()
            sets = [shingle_set(t, hashes) for t in texts]
            none = pa.nulls(len(texts), pa.int64())
            yield {
                "doc_id": batch.column(0),
                "node": [node_of(s) for s in sets],
                "n": [len(s) for s in sets],
                "text_key": [text_of(t) for t in texts],
                "token": none,
                "times": none,
            }
            waiting.extend(sets)
            size += sum(map(len, sets))
            if size >= SHINGLES_AT_ONCE:
                yield common()
                size = 0
        if waiting:
            yield common()

    return map_batches(
        docs,
        f"doc_id {kind}, node bigint, n int, text_key bigint, token bigint, times bigint",
        work,
    )


def common_shingles(read: DataFrame) -> np.ndarray:
    """At most ``COMMON_KEPT`` shingles that many documents have, the most frequent last."""
    times = F.sum("times").alias("times")
    found = (
        read.filter("token IS NOT NULL")
        .groupBy("token")
        .agg(times)
        .orderBy(F.desc("times"), "token")
        .limit(COMMON_KEPT)
        .toArrow()
    )
    return found["token"].to_numpy()[::-1].astype(np.int64).view(np.uint64)


def starting_shingles(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """``node, n, tokens, bitmap``: the first shingles of each set in the common order.

    A task sends a node once as long as it remembers it; a node of several tasks comes repeatedly.
    """
    order = np.argsort(common, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, rank = shared.value
        hashes = _WordHashes()
        seen: set[int] = set()
        for batch in small(batches):
            out: dict[str, list] = {"node": [], "n": [], "tokens": [], "bitmap": []}
            for text in batch.column(0).to_pylist():
                found = shingle_set(text, hashes)
                node = node_of(found)
                if not len(found) or node in seen:
                    continue
                if len(seen) >= WORDS_KEPT:
                    seen.clear()
                seen.add(node)
                first = found
                if len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    late = known[at] == found
                    last = found[late][np.argsort(rank[at[late]])]
                    first = np.concatenate([found[~late], last])
                out["node"].append(node)
                out["n"].append(len(found))
                out["tokens"].append(signed(first[: prefix_size(len(found))].copy()))
                out["bitmap"].append(bitmap(found))
            yield out

    return map_batches(
        docs.select("text"), "node bigint, n int, tokens array<bigint>, bitmap binary", work
    )


def _shared_lists(batch: pa.RecordBatch, shared: BitFilter) -> tuple[np.ndarray, ...]:
    """Owner (row), token, place in the owner's order and whether it is an end, of the starting
    shingles that the filter holds, in order.

    Ends are the first and last ``ENDS`` of those in the first ninth of the order, which is where
    sets of one size share their first shingle; at least the first is one.
    """
    lists = batch.column("tokens")
    tokens = lists.flatten().to_numpy()
    sizes = lists.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = shared.holds(tokens)
    owner, tokens, place = owner[kept], tokens[kept], place[kept]
    n = batch.column("n").to_numpy()[owner]
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
    early = (9 * place <= n) | (nth == 0)
    number = np.cumsum(early)
    last = np.searchsorted(owner, owner, side="right") - 1
    end = early & ((nth < ENDS) | (number[last] - number < ENDS))
    return owner, tokens, place, end


def _shared_rows(starts: DataFrame, shared: BitFilter) -> DataFrame:
    """``token, node, n`` for the starting shingles that the filter holds, how many shingles are
    ``left`` in the node's order from it on, and whether it is an end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            owner, tokens, place, end = _shared_lists(batch, shared)
            n = batch.column("n").to_numpy()[owner]
            yield {
                "token": tokens,
                "end": end,
                "node": batch.column("node").to_numpy()[owner],
                "n": n,
                "left": n - place,
            }

    return map_batches(
        starts.select("node", "n", "tokens"),
        "token bigint, end boolean, node bigint, n int, left int",
        work,
    )


def _signatures(starts: DataFrame, shared: BitFilter) -> DataFrame:
    """``node, n, weight, bitmap, ends`` of nodes with a shingle that the filter holds: how many
    it holds, and the packed end shingles, the last repeated to fill up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            owner, tokens, _, end = _shared_lists(batch, shared)
            rows, weight = np.unique(owner, return_counts=True)
            owner, tokens = owner[end], tokens[end]
            begin = np.searchsorted(owner, rows)
            size = np.searchsorted(owner, rows, side="right") - begin
            nth = np.minimum(np.arange(2 * ENDS)[None, :], size[:, None] - 1)
            ends = tokens[begin[:, None] + nth] if len(rows) else np.zeros((0, 2 * ENDS))
            chosen = batch.take(pa.array(rows))
            yield {
                "node": chosen.column("node"),
                "n": chosen.column("n"),
                "weight": weight,
                "bitmap": chosen.column("bitmap"),
                "ends": [row.tobytes() for row in ends],
            }

    names = "node bigint, n int, weight int, bitmap binary, ends binary"
    found = map_batches(starts, names, work)
    return found.dropDuplicates(["node", "n"])


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Whole groups of equal tokens from sorted batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]).select(columns)
        if rest is not None:
            table = pa.concat_tables([rest, table])
        tokens = table["token"].to_numpy()
        if not len(tokens):
            continue
        end = int(np.searchsorted(tokens, tokens[-1]))
        if end:
            yield table.slice(0, end).combine_chunks()
        rest = table.slice(end)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _in_reach(smaller, larger):
    """Whether sets of these sizes can reach the threshold."""
    return DENOMINATOR * smaller >= NUMERATOR * larger


_ROW = "token bigint, node bigint, n int, label bigint, left int"
_ROW_NAMES = ["token", "node", "n", "label", "left"]


def _most_partner(n: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The largest partner for which ``left`` shared shingles reach the threshold."""
    share = NUMERATOR + DENOMINATOR
    return share * left.astype(np.int64) // NUMERATOR - n


def _has_partner(
    group: np.ndarray, n: np.ndarray, label: np.ndarray, left: np.ndarray, end: np.ndarray
) -> np.ndarray:
    """Which rows, sorted by group and size, have a partner in their group: of another label, of a
    size in reach, with enough left in both orders, and not an end of both.

    Rows with more than ``NEIGHBOURS`` larger nodes in reach count as having one, and so do these.
    """
    found = np.zeros(len(group), bool)
    sizes, left = n.astype(np.int64), left.astype(np.int64)
    share = NUMERATOR + DENOMINATOR
    rows = np.arange(len(group))
    for step in range(1, NEIGHBOURS + 2):
        rows = rows[: np.searchsorted(rows, len(group) - step)]
        others = rows + step
        near = (group[rows] == group[others]) & _in_reach(sizes[rows], sizes[others])
        rows, others = rows[near], others[near]
        if not len(rows):
            return found
        if step > NEIGHBOURS:
            break
        both = share * np.minimum(left[rows], left[others])
        fits = both >= NUMERATOR * (sizes[rows] + sizes[others])
        fits &= (label[rows] != label[others]) & ~(end[rows] & end[others])
        found[rows[fits]] = True
        found[others[fits]] = True
    spread = group.astype(np.int64) << 32
    most = DENOMINATOR * sizes[rows] // NUMERATOR
    last = np.searchsorted(spread | sizes, spread[rows] | most, side="right")
    size = len(group) + 1
    inside = np.cumsum(np.bincount(rows, minlength=size) - np.bincount(last, minlength=size))
    return found | (inside[:-1] > 0)


def _with_neighbours(rows: DataFrame, anywhere: bool) -> DataFrame:
    """The rows that may have a partner in their group: another component's node of a size in
    reach, and, unless ``anywhere``, one small enough for what is left of the row's order, in a
    group that is not of ends alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for table in _groups(batches, [*_ROW_NAMES, "end"]):
            columns = [c.to_numpy() for c in table.columns]
            # Sorted by token and size: neighbours in reach of another label mark both; between
            # rows of one label the nearest other label is what counts.
            fresh = np.ones(len(columns[0]), bool)
            fresh[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            token, node, n, label, left, end = (c[fresh] for c in columns)
            keep = np.zeros(len(token), bool)
            for step in (1, -1):
                t, m, of = token[::step], n[::step], label[::step]
                change = np.r_[False, (t[1:] != t[:-1]) | (of[1:] != of[:-1])]
                start = np.maximum.accumulate(np.where(change, np.arange(len(t)), 0))
                before = np.maximum(start - 1, 0)
                ok = (start > 0) & (t[before] == t)
                reach = _in_reach(np.minimum(m[before], m), np.maximum(m[before], m))
                keep |= (ok & reach)[::step]
            if not anywhere:
                group = np.cumsum(np.r_[False, token[1:] != token[:-1]]).astype(np.int64)
                sizes = n.astype(np.int64)
                most = np.minimum(DENOMINATOR * sizes // NUMERATOR, _most_partner(n, left))
                least = -(-NUMERATOR * sizes // DENOMINATOR)
                spread = group << 32
                low = np.searchsorted(spread | sizes, spread | least)
                high = np.searchsorted(spread | sizes, spread | np.maximum(most, 0), side="right")
                keep &= high - low > (most >= sizes)
                # Nodes that all have the shingle as an end have met before.
                keep &= np.bincount(group, keep & ~end, int(group[-1]) + 1)[group] > 0
                keep &= _has_partner(group, n, label, left, end)
            values = (x[keep] for x in (token, node, n, label, left))
            yield dict(zip(_ROW_NAMES, values, strict=True))

    ordered = rows.select(*_ROW_NAMES, "end").repartition("token")
    return map_batches(ordered.sortWithinPartitions("token", "n", "node"), _ROW, work)


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap at a smaller power of two, as hashing to that size would have made it."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), 0)


def _exceeds(bits: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bound lets one set reach the threshold with each of the others."""
    apart = np.bitwise_count(bits ^ others).sum(1, dtype=np.int64)
    overlap = np.minimum((n + sizes - apart) // 2, np.minimum(n, sizes))
    return DENOMINATOR * overlap >= NUMERATOR * (n + sizes - overlap)


_NO_END = np.iinfo(np.int64).max


def _least_common(ends: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Per row of ``ends`` the least value that ``own`` has too; the largest number without one."""
    both = (ends[:, :, None] == own[None, None, :]).any(2)
    return np.where(both, ends, _NO_END).min(1)


class _Band:
    """The nodes of a group whose bitmaps are of one width, in order of size."""

    def __init__(self, rows: np.ndarray, n: np.ndarray, bitmaps: list[bytes]) -> None:
        self.rows, self.n = rows, n[rows].astype(np.int64)
        self.bits = np.frombuffer(b"".join(bitmaps[i] for i in rows), np.uint64)
        self.bits = self.bits.reshape(len(rows), -1)


def _leader_pairs(
    node: np.ndarray,
    n: np.ndarray,
    label: np.ndarray,
    bitmaps: list[bytes],
    weight: np.ndarray,
    ends: np.ndarray,
    token: int,
) -> list[tuple[int, int, int, int]]:
    """Per node a pair with the weightiest leader within the bound; a node without one leads.

    The node that shares most starting shingles is likeliest to be near all others.  A pair whose
    least common end is another than the group's ``token`` is left to that group or a later round.
    """
    out = []
    order = np.lexsort((node, -weight))
    maps = [np.frombuffer(b, np.uint64) for b in bitmaps]
    leaders: dict[int, list[int]] = {}  # by the width of their bitmaps
    for i in order:
        size, width = int(n[i]), len(maps[i])
        best: tuple | None = None
        for other in (width // 2, width, width * 2):
            rows = np.array(leaders.get(other, []), np.int64)
            if not len(rows):
                continue
            reach = _in_reach(np.minimum(n[rows], size), np.maximum(n[rows], size))
            rows = rows[reach & (label[rows] != label[i])]
            common = min(width, other)
            for begin in range(0, len(rows), TILE):
                tile = rows[begin : begin + TILE]
                bits = np.stack([_folded(maps[j], common) for j in tile])
                sizes = n[tile].astype(np.int64)
                near = tile[_exceeds(_folded(maps[i], common), size, bits, sizes)]
                if len(near):
                    rank = (-int(weight[near[0]]), int(node[near[0]]), int(near[0]))
                    best = rank if best is None else min(best, rank)
                    break
        if best is None:
            leaders.setdefault(width, []).append(int(i))
        elif _least_common(ends[best[2]][None, :], ends[i])[0] == token:
            out.append((int(node[i]), size, int(node[best[2]]), int(n[best[2]])))
    return out


def _first_per_label(labels: np.ndarray, most: int) -> np.ndarray:
    """Which of some rows are among the first ``most`` of their label."""
    order = np.argsort(labels, kind="stable")
    in_order = labels[order]
    start = np.maximum.accumulate(
        np.where(np.r_[True, in_order[1:] != in_order[:-1]], np.arange(len(order)), 0)
    )
    out = np.zeros(len(labels), bool)
    out[order] = np.arange(len(order)) - start < most
    return out


def _pairs_in_group(
    node: np.ndarray,
    n: np.ndarray,
    label: np.ndarray,
    bitmaps: list[bytes],
    most: int | None,
    ends: np.ndarray | None = None,
    token: int | None = None,
    left: np.ndarray | None = None,
    before: list[list[int]] | None = None,
) -> list[tuple[int, int, int, int]]:
    """Pairs (node, n, earlier node, its n) within the bound, of nodes sorted by size.

    Per node ``most`` with each other label, or all.  Sizes in reach have bitmaps of one width or
    of two that follow each other.  With ``ends`` and a ``token`` only pairs that have it as their
    least common end; with ``ends`` alone only pairs without a common end.  With ``left`` only pairs
    that can reach the threshold if the group's shingle is their first.  Pairs with a common
    shingle ``before`` the group's are left to that one's group.
    """
    widths = np.array([len(b) // 8 for b in bitmaps])
    bands = {w: _Band(np.flatnonzero(widths == w), n, bitmaps) for w in np.unique(widths)}
    out = []
    for i in range(1, len(node)):
        size = int(n[i])
        own = bands[widths[i]]
        place = int(np.searchsorted(own.rows, i))
        least = -(-NUMERATOR * size // DENOMINATOR)
        near = []
        for width in (widths[i] // 2, widths[i]):
            band = bands.get(width)
            if band is None:
                continue
            bits = _folded(own.bits[place], int(width))
            end = place if band is own else len(band.rows)
            for begin in range(int(np.searchsorted(band.n, least)), end, TILE):
                tile = slice(begin, min(begin + TILE, end))
                rows = band.rows[tile]
                open_pair = label[rows] != label[i]
                if left is not None:
                    common = np.minimum(left[rows], left[i]).astype(np.int64)
                    open_pair &= _most_partner(n[rows], common) >= size
                if ends is not None and open_pair.any():
                    least_end = _least_common(ends[rows], ends[i])
                    open_pair &= least_end == (_NO_END if token is None else token)
                may = np.flatnonzero(open_pair)
                if len(may):
                    some = slice(None) if len(may) == len(rows) else may
                    bound = _exceeds(bits, size, band.bits[tile][some], band.n[tile][some])
                    near.extend(rows[may[bound]])
        if before is not None and near and before[i]:
            apart = set(before[i]).isdisjoint
            near = [j for j in near if apart(before[j])]
        if not near:
            continue
        found = np.array(near)
        if most is not None:
            found = found[_first_per_label(label[found], most)]
        out.extend((int(node[i]), size, int(node[j]), int(n[j])) for j in found)
    return out


def _with_before(rows: DataFrame) -> DataFrame:
    """The rows with the tokens ``before`` theirs in the node's order that it has rows of, at most
    the first ``BEFORE_KEPT``."""
    of_node = Window.partitionBy("node", "n").orderBy(F.desc("left"))
    first = F.when(F.col("nth") <= BEFORE_KEPT, F.col("token"))
    whole = of_node.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        rows.withColumn("nth", F.row_number().over(of_node))
        .withColumn("before", F.collect_list(first).over(whole))
        .withColumn("before", F.slice("before", 1, F.col("nth") - 1))
        .drop("nth")
    )


def _candidate_pairs(
    rows: DataFrame, signatures: DataFrame, which: str, most: int | None
) -> DataFrame:
    """Distinct pairs ``a, a_n, b, b_n`` of nodes that share a token and stay within the bound."""
    if which == "all":
        rows = _with_before(rows)
        sent = [*_ROW_NAMES, "bitmap", "before"]
    else:
        sent = [*_ROW_NAMES, "bitmap", "weight", "ends"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for table in _groups(batches, sent):
            token, node, n, label, left = (table[c].to_numpy() for c in _ROW_NAMES)
            maps = table["bitmap"].to_pylist()
            if which == "all":
                before = table["before"].to_pylist()
            else:
                weight = table["weight"].to_numpy()
                ends = np.frombuffer(b"".join(table["ends"].to_pylist()), np.int64)
                ends = ends.reshape(-1, 2 * ENDS)
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            found: set = set()
            for begin, end in zip(starts, [*starts[1:], len(token)], strict=True):
                if end - begin == 1:
                    continue
                part = slice(begin, end)
                group = (node[part], n[part], label[part], maps[part])
                if most == LEADERS:
                    found.update(_leader_pairs(*group, weight[part], ends[part], token[begin]))
                elif which == "ends":
                    found.update(_pairs_in_group(*group, most, ends[part], token[begin]))
                else:
                    found.update(
                        _pairs_in_group(*group, most, left=left[part], before=before[part])
                    )
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            yield dict(zip(("a", "a_n", "b", "b_n"), columns, strict=True))

    joined = rows.join(signatures, ["node", "n"])
    ordered = joined.repartition("token").sortWithinPartitions("token", "n", "node")
    pairs = map_batches(
        ordered.select(*sent),
        "a bigint, a_n int, b bigint, b_n int",
        work,
    )
    swap = F.col("a") < F.col("b")
    return pairs.select(
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("a"),
        F.when(swap, F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("b"),
        F.when(swap, F.col("b_n")).otherwise(F.col("a_n")).alias("b_n"),
    ).distinct()


def _sets_of(docs: DataFrame, texts: BitFilter) -> DataFrame:
    """``node, n, members`` of the texts that the filter holds, the members as packed numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = _WordHashes()
        seen: set[int] = set()
        for batch in small(batches):
            rows = batch.column(0).to_pylist()
            keys = np.array([text_of(t) for t in rows], np.int64)
            out: dict[str, list] = {"node": [], "n": [], "members": []}
            for i in np.flatnonzero(texts.holds(keys)):
                found = shingle_set(rows[i], hashes)
                node = node_of(found)
                if len(found) and node not in seen:
                    if len(seen) >= WORDS_KEPT:
                        seen.clear()
                    seen.add(node)
                    out["node"].append(node)
                    out["n"].append(len(found))
                    out["members"].append(found.tobytes())
            yield out

    return map_batches(docs.select("text"), "node bigint, n int, members binary", work)


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, staging: Staging) -> DataFrame:
    """The pairs whose exact intersection reaches the threshold."""
    ends = pairs.select(F.col("a").alias("node"), F.col("a_n").alias("n")).union(
        pairs.select("b", "b_n")
    )
    texts = BitFilter(nodes.join(ends.distinct(), ["node", "n"]), "text_key")
    sets = staging.table(_sets_of(docs, texts).dropDuplicates(["node", "n"]))
    left = sets.toDF("a", "a_n", "a_members")
    right = sets.toDF("b", "b_n", "b_members")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                ours, theirs = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3)
                )
                both = len(np.intersect1d(ours, theirs, assume_unique=True))
                keep.append(DENOMINATOR * both >= NUMERATOR * (len(ours) + len(theirs) - both))
            chosen = pa.array(keep, pa.bool_())
            yield {"a": batch.column(0).filter(chosen), "b": batch.column(1).filter(chosen)}

    joined = pairs.join(left, ["a", "a_n"]).join(right, ["b", "b_n"])
    return map_batches(
        joined.select("a", "b", "a_members", "b_members"), "a bigint, b bigint", work
    )


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    joined = rows.join(labels.hint("merge"), "node", "left")
    return joined.withColumn("label", F.coalesce("label", "node"))


def link_nodes(docs: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (``doc_id, node, n``), the links between nodes and the nodes' labels."""
    read = staging.table(read_sets(docs))
    documents = read.filter("token IS NULL").select("doc_id", "node", "n", "text_key")
    common = common_shingles(read)
    nodes = documents.filter("n > 0").groupBy("node", "n").agg(F.min("text_key").alias("text_key"))
    with Staging(docs.sparkSession) as first:
        starts = first.table(starting_shingles(docs, common))
        counts = starts.select(F.explode("tokens").alias("token")).groupBy("token").agg(
            F.count("*").alias("times")
        )
        shared = BitFilter(counts.filter("times > 1"), "token")
        rows = staging.table(_shared_rows(starts, shared))
        signatures = staging.table(_signatures(starts, shared))

    links: DataFrame | None = None
    labels: DataFrame | None = None
    tried: DataFrame | None = None
    for which, most in ROUNDS:
        now = rows.filter("end") if which == "ends" else rows
        give_back_driver(docs.sparkSession)
        near = _with_neighbours(_labelled(now, labels), anywhere=which == "ends")
        if which == "all":
            near = staging.table(near)
        pairs = _candidate_pairs(near, signatures, which, most)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "a_n", "b", "b_n"], "left_anti")
        pairs, seen = staging.measured_table(pairs, n="count(*)")
        if not seen["n"]:
            continue
        tried = pairs if tried is None else tried.union(pairs)
        found, linked = staging.measured_table(_linked(pairs, nodes, docs, staging), n="count(*)")
        if linked["n"]:
            links = found if links is None else links.union(found)
            if which == "ends":
                labels = components(links, staging, most_rounds=2)
    if links is None:
        links = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    labels = components(links, staging)
    return documents, links, labels


def shingle_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id``, ``text``).

    Texts are taken whole, A-Z lower-cased, words split at ASCII white space.  Documents link when
    100 * intersection >= 80 * union of their sets; ``component_id`` is the least id reached.  A
    null or empty text has an empty set and links with nothing.  A null id is no component's least
    id unless all are null.  Rows with one id and different texts are documents of their own.
    Other columns are ignored.  Sets and shingles are told apart by 64-bit hashes (sets also by
    their size).
    """
    staging = Staging(docs.sparkSession)
    with shuffles_dropped(docs.sparkSession):
        documents, _, labels = link_nodes(docs, staging)
        named = (
            documents.filter("n > 0")
            .groupBy("node", "n")
            .agg(F.min("doc_id").alias("least"))
            .join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node"))
        )
        least = named.groupBy("label").agg(F.min("least").alias("component_id"))
        by_node = staging.table(named.join(least, "label").select("node", "n", "component_id"))
    return documents.join(by_node, ["node", "n"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, the one with its least id, with all columns.

    Rows that repeat an id are one document: one of them stays.  Rows with a null id all stay.
    """
    staging = Staging(docs.sparkSession)
    found = staging.table(shingle_components(docs))
    others = (
        found.filter(F.col("component_id") != F.col("doc_id"))
        .select(F.col("doc_id").alias("__copy"))
        .distinct()
    )
    kept = docs.join(others.hint("merge"), docs["doc_id"] == others["__copy"], "left_anti")
    repeated, seen = staging.measured_table(
        found.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__again"))
        .agg(F.count("*").alias("__times"))
        .filter(F.col("__times") > 1),
        n="count(*)",
    )
    if not seen["n"]:
        return kept
    same = kept["doc_id"] == repeated["__again"]
    return kept.join(repeated, same, "left_anti").unionByName(
        kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"])
    )
