"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens.

A pre-token's best segmentation has the forward scores ``best[i] = max over pieces ending at i of
best[i - len(piece)] + log p(piece)``.  ``best[i]`` depends on the first ``i`` bytes alone, so the
distinct pre-tokens go into a trie whose nodes hold the forward score and the number of pieces:
a shared prefix is scored once, and the count at the node where a pre-token ends is its token
count.  Equal scores are settled by fewer pieces.

The pieces come from a public rank file; their probabilities follow their ranks (``rank_scores``),
as a rank file has no scores of its own.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sluicework.llm.arrow import map_batches
from sluicework.llm.bpe_automaton import SPLIT

NODES_KEPT = 1_000_000
ZIPF_SHIFT = 2.7


def rank_scores(path: str) -> dict[bytes, float]:
    """Log probabilities of the pieces: rank ``r`` weighs 1 / (r + ``ZIPF_SHIFT``), summing to 1."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in ranks.values()))
    return {piece: -math.log(r + ZIPF_SHIFT) - total for piece, r in ranks.items()}


class ScoreTrie:
    """Forward scores of all prefixes seen.  A byte without a piece costs ``floor``."""

    def __init__(self, scores: dict[bytes, float]) -> None:
        self._scores = scores
        self._suffixes = {piece[i:] for piece in scores for i in range(len(piece))}
        self._floor = min(scores.values(), default=0.0) - 10.0
        self.terminal: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self._next: dict[int, int] = {}
        self._best, self._count = [0.0], [0]
        self.terminal.clear()

    def insert(self, token: str) -> int:
        """The token count of a pre-token, scored from the first byte not in the trie on."""
        if len(self._best) >= NODES_KEPT:
            self._clear()
        word = token.encode()
        node, path = 0, [0]
        for end, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = self._next.get(key, -1)
            if node < 0:
                node = self._next[key] = self._score(word, end, path)
            path.append(node)
        count = self.terminal[token] = self._count[node]
        return count

    def _score(self, word: bytes, end: int, path: list[int]) -> int:
        scores, best, count = self._scores.get, self._best, self._count
        top, pieces = best[path[end - 1]] + self._floor, count[path[end - 1]] + 1
        for begin in range(end - 1, -1, -1):
            piece = word[begin:end]
            if piece not in self._suffixes:
                break
            score = scores(piece)
            if score is not None:
                score += best[path[begin]]
                n = count[path[begin]] + 1
                if score > top or score == top and n < pieces:
                    top, pieces = score, n
        best.append(top)
        count.append(pieces)
        return len(best) - 1


@lru_cache(maxsize=2)
def _trie(path: str) -> ScoreTrie:
    return ScoreTrie(rank_scores(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_pretokens, n_distinct, n_tokens`` of each whole text.

    A null or empty text has 0 of each; rows that repeat are answered each; other columns are
    ignored.  Nothing is shuffled.  A worker's trie is emptied at ``NODES_KEPT`` nodes, so memory is
    bounded by that and a batch; a single longer pre-token grows it by its own bytes once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trie, split = _trie(path), regex.compile(SPLIT).findall
        for batch in batches:
            pretokens, distinct, tokens = [], [], []
            for text in batch.column(1):
                words = split(text.as_py() or "")
                new = set(words)
                counts = {w: trie.terminal.get(w) or trie.insert(w) for w in new}
                pretokens.append(len(words))
                distinct.append(len(new))
                tokens.append(sum(map(counts.__getitem__, words)))
            yield {
                "doc_id": batch.column(0),
                "n_pretokens": pretokens,
                "n_distinct": distinct,
                "n_tokens": tokens,
            }

    return map_batches(
        docs.select("doc_id", "text"),
        "doc_id bigint, n_pretokens bigint, n_distinct bigint, n_tokens bigint",
        work,
    )
