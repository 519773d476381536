"""Periodic runs of words, found on a grammar-compressed form of the texts.

A run is a stretch of words with smallest period ``q`` that is at least ``LEAST_LENGTH`` words and
``LEAST_EXPONENT`` periods long and that no neighbouring word extends.

Documents are taken in batches.  Re-Pair replaces pairs of symbols that a document has more than
once by a new symbol, in rounds: a round replaces each pair wherever it outranks the pairs it
overlaps, the most frequent first, until no pair is left twice.  The sequence that remains is made a
balanced tree.  Every nonterminal of the grammar and every node of that tree has one inner boundary,
and a run lies whole in the lowest nonterminal or node that holds it, across its boundary.  So the
runs across each boundary are looked for once, however often the nonterminal is derived, and then
moved to all positions where it is.  What the rest of the document extends there is part of a run
that a higher node has whole, and goes; what several nodes have found is merged.

Across a boundary, a run of three periods repeats the ``ANCHOR`` words on one side of the boundary
at the distance of its period, so the distances of equal anchors are the candidates.  How far a
candidate's period reaches comes from prefix hashes; the intervals found are then compared word by
word.  A document without a repeated anchor has no run and needs no grammar.

A batch holds ``BATCH_WORDS`` words, or one longer document, in arrays of some 150 bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.arrow import map_batches
from sluicework.llm.columns import let, words

# Fixed values of the contract.
LEAST_LENGTH, LEAST_EXPONENT = 24, 3

# A run of L >= 24 words and 3 periods has L / 2 words on one side of a boundary, which are a period
# and L / 6 >= 4 words at least.
ANCHOR = 4
BATCH_WORDS = 1 << 18
CANDIDATES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15


class Nodes(NamedTuple):
    """Where a nonterminal or tree node lies (first derivation) and its boundary; ``rule`` is -1 for
    a node of the tree, which is derived nowhere else."""

    low: np.ndarray
    boundary: np.ndarray
    high: np.ndarray
    rule: np.ndarray


class Runs(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, the begin of each group of equal ones, and the groups' sizes."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else order
    return order, begins, np.diff(np.r_[begins, len(keys)])


def anchors(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per position a number of the ``ANCHOR`` words from there, equal for equal ones of one
    document, or -1 where a document has them once (or they reach beyond it)."""
    found = np.full(len(ids), -1, np.int64)
    size = len(ids) - ANCHOR + 1
    if size <= 0:
        return found
    places = np.flatnonzero(doc[:size] == doc[ANCHOR - 1 :])
    code = doc[places].astype(np.uint64)
    for k in range(ANCHOR):
        code = (code ^ (code >> np.uint64(29))) * np.uint64(MULTIPLIER)
        code += ids[places + k].astype(np.uint64)
    order, begins, sizes = _groups(code)
    number = np.where(sizes > 1, np.arange(len(sizes)), -1)
    found[places[order]] = np.repeat(number, sizes)
    return found


def re_pair(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """The positions where symbols of the remaining sequence begin, and per round its rules: the
    position of every replaced pair, its rule's number, its left part's and its whole length.

    Symbols stay at the position of their first word and know their neighbours, so a round costs what
    may have changed.  Pairs are counted per document, without overlapping copies of themselves.
    """
    n = len(ids)
    symbol = np.append(ids, -1)
    owner = np.append(doc, -1)
    length = np.ones(n + 1, np.int64)
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    alive = np.ones(n + 1, bool)
    rank = np.zeros(n + 1, np.int64)
    symbols = int(ids.max(initial=-1)) + 1
    live = np.arange(n)
    rounds = []
    rules = 0
    while True:
        live = live[alive[live] & (after[live] < n)]
        live = live[owner[live] == owner[after[live]]]
        if not len(live):
            break
        left, right = symbol[live], symbol[after[live]]
        # Pairs by document: three numbers in two steps, so that no product overflows.
        _, pair = np.unique(left * symbols + right, return_inverse=True)
        code = owner[live] * (int(pair.max()) + 1) + pair
        # Of overlapping copies (a a a) every second one counts.
        same = np.r_[False, (code[1:] == code[:-1]) & (after[live[:-1]] == live[1:])]
        index = np.arange(len(live))
        first = np.maximum.accumulate(np.where(same, 0, index))
        counted = np.flatnonzero((index - first) % 2 == 0)
        order, begins, sizes = _groups(code[counted])
        if not (sizes > 1).any():
            break
        # Ranks of pairs by count; a higher rank wins where two pairs overlap.
        by_count = np.empty(len(sizes), np.int64)
        by_count[np.argsort(sizes, kind="stable")] = np.arange(1, len(sizes) + 1)
        ranks = np.empty(len(counted), np.int64)
        ranks[order] = np.repeat(np.where(sizes > 1, by_count, 0), sizes)
        repeated = ranks > 0
        candidates, ranks = live[counted[repeated]], ranks[repeated]
        rank[candidates] = ranks
        wins = (ranks > rank[before[candidates]]) & (ranks > rank[after[candidates]])
        rank[candidates] = 0
        chosen, of = candidates[wins], ranks[wins]
        # A rule needs two places; the highest rank of a document always has them.
        _, inverse, times = np.unique(of, return_inverse=True, return_counts=True)
        twice = times[inverse] > 1
        chosen, rule = chosen[twice], np.unique(inverse[twice], return_inverse=True)[1]
        second = after[chosen]
        whole = length[chosen] + length[second]
        rounds.append((chosen, rules + rule, length[chosen], whole))
        rules += int(rule.max()) + 1
        symbol[chosen] = symbols + rule
        symbols += int(rule.max()) + 1
        length[chosen] = whole
        alive[second] = False
        after[chosen] = after[second]
        before[after[chosen]] = chosen
        # Pairs that were not repeated stay so unless a part of them is new.
        again = np.concatenate([candidates, live[same], chosen, before[chosen]])
        live = np.unique(again[again >= 0])
    return np.flatnonzero(alive[:n]), rounds


def tree_nodes(starts: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> Nodes:
    """Inner nodes of a balanced tree over each document's remaining symbols."""
    owner = doc[starts]
    edge = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    high = np.where(np.r_[edge[1:], True][: len(owner)], ends[owner], np.r_[starts[1:], 0])
    low, parts = starts, []
    while len(low):
        edge = np.r_[True, owner[1:] != owner[:-1]]
        index = np.arange(len(low))
        place = index - np.maximum.accumulate(np.where(edge, index, 0))
        is_left = place % 2 == 0
        paired = np.flatnonzero(is_left & np.r_[~edge[1:], False])
        if not len(paired):
            break
        parts.append((low[paired], low[paired + 1], high[paired + 1]))
        high = high.copy()
        high[paired] = high[paired + 1]
        low, high, owner = low[is_left], high[is_left], owner[is_left]
    if not parts:
        return Nodes(*(np.zeros(0, np.int64) for _ in range(4)))
    low, boundary, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Nodes(low, boundary, high, np.full(len(low), -1))


class Prefixes:
    """Equality of stretches by sums of words times powers, modulo 2 ** 64."""

    def __init__(self, ids: np.ndarray) -> None:
        value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIER)
        value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 | 1)
        factor = MULTIPLIER | 1
        power = np.full(len(ids) + 1, factor, np.uint64)
        inverse = np.full(len(ids) + 1, pow(factor, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        self._sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(value * np.cumprod(power)[:-1], out=self._sums[1:])
        self._inverse = np.cumprod(inverse)

    def _hash(self, begin: np.ndarray, size: int) -> np.ndarray:
        return (self._sums[begin + size] - self._sums[begin]) * self._inverse[begin]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (or before them) are equal, at most ``most``."""
        done = np.zeros(len(a), np.int64)
        step = 1 << max(int(most.max(initial=0)).bit_length() - 1, 0)
        while step:
            at = np.flatnonzero(done + step <= most)
            if forward:
                one, two = a[at] + done[at], b[at] + done[at]
            else:
                one, two = a[at] - done[at] - step, b[at] - done[at] - step
            done[at[self._hash(one, step) == self._hash(two, step)]] += step
            step >>= 1
        return done


def _expanded(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and which range each is of."""
    sizes = end - begin
    of = np.repeat(np.arange(len(begin)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[of], of


def _reach(ids: np.ndarray, low: int, high: int, place: int, q: int) -> tuple[int, int]:
    """How far period ``q`` holds around a place and the one a period on, word by word."""
    differs = np.flatnonzero(ids[low : high - q] != ids[low + q : high]) + low
    at = np.searchsorted(differs, place)
    start = int(differs[at - 1]) + 1 if at else low
    return start, int(differs[at]) + q if at < len(differs) else high


def _long_enough(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    return (end - start >= LEAST_LENGTH) & (end - start >= LEAST_EXPONENT * period)


def boundary_runs(ids: np.ndarray, gram: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, Runs]:
    """The runs across the nodes' boundaries, within the nodes, each with its node's index."""
    n = len(ids)
    prefixes = Prefixes(ids)
    places = np.flatnonzero(gram >= 0)
    keys = gram[places] * (n + 1) + places
    order = np.argsort(keys)
    keys, places = keys[order], places[order]
    found: list[tuple[np.ndarray, ...]] = []
    for right in (True, False):
        # On the right the anchor begins at the boundary and comes again a period later; on the
        # left it ends there and was a period before.
        at = nodes.boundary if right else nodes.boundary - ANCHOR
        fits = (at >= nodes.low) & (at + ANCHOR <= nodes.high)
        fits &= nodes.high - nodes.low >= LEAST_LENGTH
        own = np.where(fits, gram[np.minimum(np.maximum(at, 0), n - 1)], -1)
        some = np.flatnonzero(own >= 0)
        at, own = at[some], own[some]
        most = (nodes.high[some] - nodes.low[some]) // LEAST_EXPONENT
        if right:
            first, last = at + 1, np.minimum(at + most, nodes.high[some] - ANCHOR)
        else:
            first, last = np.maximum(at - most, nodes.low[some]), at - 1
        begin = np.searchsorted(keys, own * (n + 1) + first)
        end = np.maximum(np.searchsorted(keys, own * (n + 1) + last, "right"), begin)
        # So many nodes at a time that their candidates fit.
        load = np.cumsum(end - begin) // CANDIDATES
        for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(load)) + 1):
            where, of = _expanded(begin[part], end[part])
            node = some[part][of]
            low, high = nodes.low[node], nodes.high[node]
            one = np.minimum(places[where], at[part][of])
            two = np.maximum(places[where], at[part][of])
            q = two - one
            start = one - prefixes.common(one, two, one - low, False)
            stop = two + prefixes.common(one, two, high - two, True)
            keep = _long_enough(start, stop, q)
            found.append((node[keep], start[keep], stop[keep], q[keep], one[keep]))
    every = [np.concatenate(x) for x in zip(*found, strict=True)]
    node, start, end, q, place = _distinct(*every)
    wrong = [
        not np.array_equal(ids[s : e - p], ids[s + p : e])
        for s, e, p in zip(start, end, q, strict=True)
    ]
    if any(wrong):
        # The hashes took different words for equal: their nodes' candidates are measured instead.
        doubted = np.isin(every[0], node[wrong])
        node, start, end, q, place = (x[doubted] for x in every)
        for i, k in enumerate(node):
            start[i], end[i] = _reach(ids, nodes.low[k], nodes.high[k], place[i], q[i])
        long = _long_enough(start, end, q)
        measured = (x[long] for x in (node, start, end, q, place))
        sure = (x[~doubted] for x in every)
        parts = zip(measured, sure, strict=True)
        node, start, end, q, _ = _distinct(*(np.concatenate(x) for x in parts))
    return node, Runs(start, end, q)


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """One of the rows (node, start, end, period, ...) with the same interval of a node: a multiple
    of a period has it too, so the one of the smallest period."""
    node, start, end, q = columns[:4]
    order = np.lexsort((q, end, start, node))
    ordered = [x[order] for x in columns]
    new = np.any([np.diff(x) != 0 for x in ordered[:3]], axis=0)
    return [x[np.r_[True, new][: len(order)]] for x in ordered]


def runs(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, Runs]:
    """All runs of documents of word numbers, by document, start and period.

    ``ends`` are the ends of the documents in ``ids``; the first result is each run's document.
    """
    sizes = np.diff(np.r_[0, ends])
    every = np.repeat(np.arange(len(ends)), sizes)
    gram = anchors(ids, every)
    # Documents with a repeated anchor are numbered anew, the others have no run.
    has = np.zeros(len(ends), bool)
    has[every[gram >= 0]] = True
    kept = np.flatnonzero(has)
    inside = has[every]
    ids, gram = ids[inside], gram[inside]
    sizes = sizes[kept]
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(kept)), sizes)
    none = np.zeros(0, np.int64)
    if not len(ids):
        return none, Runs(none, none, none)
    starts, rounds = re_pair(ids, doc)
    tree = tree_nodes(starts, doc, ends)
    place, rule, left, whole = (
        (np.concatenate(x) for x in zip(*rounds, strict=True)) if rounds else (none,) * 4
    )
    long = whole >= LEAST_LENGTH
    place, rule, left, whole = place[long], rule[long], left[long], whole[long]
    order, begins, times = _groups(rule)
    place, rule = place[order], rule[order]
    top = place[begins]
    derived = Nodes(top, top + left[order][begins], top + whole[order][begins], rule[begins])
    nodes = Nodes(*(np.concatenate(x) for x in zip(derived, tree, strict=True)))
    node, found = boundary_runs(ids, gram, nodes)
    # A rule's runs are moved to every place where it is derived.
    of_rule = node < len(begins)
    ranges = begins[node[of_rule]], begins[node[of_rule]] + times[node[of_rule]]
    where, of = _expanded(*ranges)
    moved = place[where] - top[node[of_rule]][of]
    start, end, q = (
        np.concatenate([x[~of_rule], x[of_rule][of] + shift])
        for x, shift in zip(found, (moved, moved, 0), strict=True)
    )
    # What goes on beyond the node is part of a run that a higher node has whole.
    own = doc[start]
    floor, ceiling = (ends - sizes)[own], ends[own]
    longer = (start > floor) & (ids[np.maximum(start - 1, 0)] == ids[start - 1 + q])
    longer |= (end < ceiling) & (ids[np.minimum(end, len(ids) - 1)] == ids[end - q])
    start, end, q, own = start[~longer], end[~longer], q[~longer], own[~longer]
    order = np.lexsort((q, end, start))
    start, end, q, own = start[order], end[order], q[order], own[order]
    new = np.r_[True, (np.diff(start) != 0) | (np.diff(end) != 0)][: len(start)]
    start, end, q, own = start[new], end[new], q[new], own[new]
    order = np.lexsort((q, start))
    first = (ends - sizes)[own]
    found = Runs(*(x[order] for x in (start - first, end - first, q)))
    return kept[own[order]], found


def _batch(texts: list[str | None]) -> tuple[list, list[str]]:
    """Runs and collapsed text of each document."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    split = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    ids = np.fromiter(
        map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum())
    )
    doc, found = runs(ids, np.cumsum(sizes))
    listed: list[list] = [[] for _ in texts]
    gone: dict[int, np.ndarray] = {}
    for d, start, end, q in zip(doc, *found, strict=True):
        listed[d].append({"start": int(start), "length": int(end - start), "period": int(q)})
        gone.setdefault(d, np.zeros(sizes[d], bool))[start + q : end] = True
    collapsed = []
    for d, own in enumerate(split):
        kept = [w for w, out in zip(own, gone[d], strict=True) if not out] if d in gone else own
        collapsed.append(b" ".join(kept).decode())
    return listed, collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each whole text.

    ``runs`` are all runs by start, then period, in words; ``collapsed`` is the text without the
    words that repeat a run's first period, its words joined by one space.  A null text has no words;
    repeated rows are answered each; a null id stays null; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin, size = 0, 0
            for i, text in enumerate(texts):
                # A word and its gap are two characters at least.
                more = len(text or "") // 4 + 1
                if i > begin and size + more > BATCH_WORDS:
                    yield _answer(batch.column(0), texts, begin, i)
                    begin, size = i, 0
                size += more
            if begin < len(texts):
                yield _answer(batch.column(0), texts, begin, len(texts))

    def _answer(ids: pa.Array, texts: list, begin: int, end: int) -> dict:
        listed, collapsed = _batch(texts[begin:end])
        return {"doc_id": ids.slice(begin, end - begin), "runs": listed, "collapsed": collapsed}

    run = "struct<start: bigint, length: bigint, period: bigint>"
    return map_batches(
        docs.select("doc_id", "text"), f"doc_id bigint, runs array<{run}>, collapsed string", work
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of all documents; where the id's hash says so, the words from some place on
    go on periodically (the contract's rewriting)."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def rewritten(own: Column) -> Column:
        n = F.size(own)
        begin = (g % n).cast("int")
        period = (1 + F.floor((n - begin) / (3 + g % 8))).cast("int")
        place = F.sequence(F.lit(0), n - 1)
        moved = F.transform(
            place, lambda i: F.when(i < begin, i).otherwise(begin + (i - begin) % period)
        )
        return F.when(
            n > 0, F.array_join(F.transform(moved, lambda i: F.get(own, i)), " ")
        ).otherwise(F.lit(""))

    chosen = F.coalesce(hashed % 10 == 0, F.lit(False)) & F.col("text").isNotNull()
    text = F.when(chosen, let(words(F.col("text")), rewritten)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``periodic_runs``.  The strongest run is the one of greatest exact
    length / period; of equal ones the first, then the one of the smallest period."""

    def stronger(best: Column, x: Column) -> Column:
        wins = best["period"].isNull() | (
            x["length"] * best["period"] > best["length"] * x["period"]
        )
        return F.when(wins, x).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    line = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    text = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    return found.withColumn("top", F.aggregate("runs", none, stronger)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
