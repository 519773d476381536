"""Byte-level BPE as a deterministic automaton over token labels.

The automaton starts as one state with an arc per byte.  The merge rules are then applied one by
one, each by a gadget: where an arc ``u`` is followed by an arc ``v``, an arc ``uv`` is added from
the first state to the last, and the state behind ``u`` is replaced by a copy without the arc
``v``, as that pair can no longer stand.  All arcs with one label lead to one state, so the state
behind a label is named by the label, and its arcs are those of the label's right part at the time
of its own gadget, less what later gadgets removed, plus the arcs of later labels.  ``Automaton``
evaluates an arc from that record of gadgets the first time it is asked for and keeps it in a
transition table.

Every accepted path spells a text by its one BPE encoding, and every state accepts, so each prefix
of a word has one accepted path.  Encoding goes over the word's bytes from left to right and
keeps, per prefix, the label of the last arc; the labels that end a prefix are found down a trie of
labels read from their ends.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sluicework.llm.arrow import map_batches

# The split pattern of the public byte-level vocabularies.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORDS_KEPT = 400_000
ARCS_KEPT = 2_000_000
BASE = -1


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others follow from code point 256.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def latin_split() -> re.Pattern:
    """``SPLIT`` for texts of Latin-1 alone, whose classes the standard library matches faster."""
    every = "".join(map(chr, range(256)))

    def ranges(kind: str) -> str:
        return "".join(
            f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in regex.findall(f"{kind}+", every)
        )

    letter, number, space = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


class Automaton:
    """States and arcs from an ordered list of merges; ``labels`` are the ids' byte strings."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.ids = ids
        self.labels = {i: label for label, i in ids.items()}
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._made: dict[int, int] = {i: BASE for label, i in ids.items() if len(label) == 1}
        self._arcs_kept = 0
        self._live: dict[bytes, int] = {label: i for label, i in ids.items() if len(label) == 1}
        for rank, (left, right) in enumerate(merges):
            self._gadget(rank, left, right)
        # Per byte the label read to here, whether it follows a label, and the bytes before it.
        self._arcs: list[dict[int, bool]] = []
        self._ends: dict[int, list] = {}
        for label, i in self._live.items():
            below = self._ends
            for byte in reversed(label):
                node = below.get(byte)
                if node is None:
                    node = below[byte] = [None, None, {}]
                below = node[2]
            node[:2] = i, {}
            self._arcs.append(node[1])

    def _gadget(self, rank: int, left: bytes, right: bytes) -> None:
        u, v, uv = self.ids[left], self.ids[right], self.ids[left + right]
        if uv in self._made:
            raise ValueError(f"two merges make {left + right!r}")
        # The new arc has a path to replace only if both parts are arcs and may still follow.
        if left in self._live and right in self._live and self._allowed(u, v, rank):
            self._live[left + right] = uv
        self._rank[u, v] = rank
        self._parts[uv] = (u, v)
        self._made[uv] = rank

    def _allowed(self, a: int, b: int, time: int) -> bool:
        """Whether the state behind ``a`` has the arc ``b`` before the gadget numbered ``time``."""
        while True:
            removed = self._rank.get((a, b))
            if removed is not None and removed < time:
                return False
            made_a, made_b = self._made[a], self._made[b]
            if made_a == made_b == BASE:
                return True
            if made_a == made_b:
                # The label follows itself: its state is its right part's, which got the new arc.
                (left, right), time = self._parts[a], made_a
                a, b = right, left
            elif made_b > made_a:
                left, right = self._parts[b]
                # Runs of one label merge from the left, so no single one stands before a pair.
                if left == right == a:
                    return False
                b, time = left, made_b
            else:
                a, time = self._parts[a][1], made_a

    def follows(self, a: int, b: int) -> bool:
        return self._allowed(a, b, len(self._rank))

    def _kept(self, a: int, b: int, arcs: dict[int, bool]) -> bool:
        """``follows``, kept in the transition table's part for ``b``."""
        if self._arcs_kept >= ARCS_KEPT:
            for part in self._arcs:
                part.clear()
            self._arcs_kept = 0
        self._arcs_kept += 1
        found = arcs[a] = self.follows(a, b)
        return found

    def encode(self, word: bytes) -> tuple[int, ...]:
        """The ids on the one accepted path that spells ``word``."""
        whole = self._live.get(word)
        if whole is not None:
            return (whole,)
        ends = self._ends
        last = [0] * (len(word) + 1)
        start = [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            begin, below = end, ends
            while begin:
                begin -= 1
                label, arcs, below = below[word[begin]]
                if label is None:
                    continue
                if begin:
                    before = last[begin]
                    arc = arcs.get(before)
                    if arc is None:
                        arc = self._kept(before, label, arcs)
                    if not arc:
                        continue
                last[end], start[end] = label, begin
                break
        path, end = [], len(word)
        while end:
            path.append(last[end])
            end = start[end]
        return tuple(reversed(path))


class Words(dict):
    """Pre-split words and their ids.

    Half of ``WORDS_KEPT`` are those asked for since the last change, the other half stood here
    before it, so frequent words stay.
    """

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self._encode = automaton.encode
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS_KEPT // 2:
            self._older = dict(self)
            self.clear()
        path = self._older.get(word)
        if path is None:
            path = self._encode(word.encode())
        self[word] = path
        return path


class Codec:
    """Encodes and decodes whole texts with a ``tokenizers`` vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()

        def raw(token: str) -> bytes:
            return bytes(symbols[c] for c in token)

        model = spec["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in self._special}
        self.automaton = Automaton(ids, [(raw(a), raw(b)) for a, b in pairs])
        self.labels = self.automaton.labels | {
            i: t.encode() for t, i in self._special.items()
        }
        self.digits = {i: str(i) for i in self.labels}
        self._words = Words(self.automaton)
        self._split, self._latin_split = regex.compile(SPLIT).findall, latin_split().findall
        found = sorted(map(regex.escape, self._special), key=len, reverse=True)
        self._cut = regex.compile(f"({'|'.join(found)})").split if found else None

    def _plain(self, text: str) -> Iterator[int]:
        try:
            text.encode("latin-1")
            split = self._latin_split
        except UnicodeEncodeError:
            split = self._split
        return chain.from_iterable(map(self._words.__getitem__, split(text)))

    def encode(self, text: str) -> list[int]:
        if self._cut is None or not any(t in text for t in self._special):
            return list(self._plain(text))
        ids: list[int] = []
        for piece in self._cut(text):
            if piece in self._special:
                ids.append(self._special[piece])
            else:
                ids.extend(self._plain(piece))
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One compiled automaton per worker process and vocabulary file."""
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``ids``, the token ids of each whole text; a null text has none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = codec(path)
        for batch in batches:
            yield {
                id_column: batch.column(0),
                "ids": [bpe.encode(t or "") for t in batch.column(1).to_pylist()],
            }

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, text), f"`{id_column}` {kind}, ids array<int>", work
    )


def decode(coded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``text``, spelled by the labels of ``ids``; null ids give null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = codec(path)
        for batch in batches:
            yield {
                id_column: batch.column(0),
                "text": [None if i is None else bpe.decode(i) for i in batch.column(1).to_pylist()],
            }

    kind = coded.schema[id_column].dataType.simpleString()
    return map_batches(
        coded.select(id_column, "ids"), f"`{id_column}` {kind}, text string", work
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and SHA-256 digests of the ids and of the decoded text.

    Ids and text pass from the encoder to the decoder inside the task, so neither is shuffled or
    stored.  A null text counts as empty; rows that repeat are answered each.  Other columns are
    ignored.  Memory per task: a batch of texts, ``WORDS_KEPT`` words and ``ARCS_KEPT`` arcs.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = codec(path)
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                listed = ",".join(map(bpe.digits.__getitem__, ids))
                ids_digest.append(hashlib.sha256(listed.encode()).hexdigest())
                text_digest.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield {
                "doc_id": batch.column(0),
                "n_tokens": counts,
                "ids_sha256": ids_digest,
                "decoded_sha256": text_digest,
            }

    return map_batches(
        docs.select("doc_id", "text"),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        work,
    )
