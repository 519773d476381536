"""Periodic runs against a comparison of all words at all distances."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sluicework.llm import periodic_runs

ODD = [None, "", " \t\n", "word", "a " * 23, "a " * 24, "  " * 30, "x\x00y " * 31, "é漢 " * 25]


def plain_runs(words):
    """Per distance the maximal stretches; a stretch counts for its smallest distance."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        begin = 0
        for i in range(n - q + 1):
            if i == n - q or words[i] != words[i + q]:
                end = i + q
                if end - begin >= max(24, 3 * q):
                    found.setdefault((begin, end), q)
                begin = i + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def found(docs):
    out = {}
    for r in periodic_runs.periodic_runs(docs).collect():
        out.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    return out


def expected(text):
    words = [w for w in (text or "").encode().split()]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def check(numbers):
    """The runs of documents of word numbers, without Spark."""
    ids = np.array([x for d in numbers for x in d], np.int64)
    doc, runs = periodic_runs.runs(ids, np.cumsum([len(d) for d in numbers]))
    got = [[] for _ in numbers]
    for d, start, end, q in zip(doc, *runs, strict=True):
        got[d].append((int(start), int(end - start), int(q)))
    for d, own in enumerate(numbers):
        assert got[d] == plain_runs(own), own


def periodic(rng):
    """Blocks, repeated, nested and cut, with noise between."""
    out = []
    for _ in range(rng.randint(1, 5)):
        block = [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.4:
            block = block * rng.randint(2, 4) + [rng.randint(0, 3)]
        stretch = block * rng.randint(1, 12)
        out += stretch[rng.randint(0, 3) : len(stretch) - rng.randint(0, 3)]
        out += [rng.randint(0, 60) for _ in range(rng.choice([0, 0, 1, 9]))]
        if rng.random() < 0.3 and out:
            out[rng.randrange(len(out))] = 99
    return out


def test_random_documents_in_batches():
    rng = random.Random(12)
    for _ in range(150):
        check([periodic(rng) for _ in range(rng.randint(1, 9))])


def test_few_words_and_long_runs():
    rng = random.Random(13)
    check([[0] * n for n in (0, 1, 23, 24, 25, 700)])
    check([[i % 2 for i in range(n)] for n in (23, 24, 301)])
    check([[rng.randint(0, 1) for _ in range(400)] for _ in range(20)])
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    check(fibonacci)
    thue = [bin(i).count("1") % 2 for i in range(512)]
    check([thue, thue * 3, [x for x in thue for _ in range(9)]])


def test_few_candidates_at_a_time_and_hashes_that_lie(monkeypatch):
    rng = random.Random(14)
    docs = [periodic(rng) for _ in range(60)]
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 5)
    check(docs)
    # Equal hashes for everything: only the words themselves decide.
    monkeypatch.setattr(
        periodic_runs.Prefixes, "_hash", lambda self, begin, size: np.zeros(len(begin))
    )
    check(docs)


def test_a_rule_derives_its_words_wherever_it_is():
    rng = random.Random(15)
    passage = [rng.randint(0, 400) for _ in range(40)]
    ids = np.array(([*passage, 7] * 3 + [3, 4] * 30) * 2, np.int64)
    doc = np.zeros(len(ids), np.int64)
    starts, rounds = periodic_runs.re_pair(ids, doc)
    assert len(starts) < len(ids) // 8
    rules = {}
    for place, rule, left, whole in zip(*(np.concatenate(x) for x in zip(*rounds)), strict=True):
        text = tuple(ids[place : place + whole])
        assert rules.setdefault(rule, (text, left)) == (text, left)
    # What remains has no pair twice.
    ends = np.r_[starts[1:], len(ids)]
    parts = [tuple(ids[s:e]) for s, e in zip(starts, ends, strict=True)]
    pairs = list(zip(parts, parts[1:]))
    assert all(pairs[i] not in pairs[i + 2 :] for i in range(len(pairs)))


def test_texts(documents, prose):
    rng = random.Random(16)
    texts = [*ODD, prose(3, 4000, kinds=30), "ab " * 60_000 + "cd ef " * 50]
    for n in range(40):
        block = prose(n, rng.randint(1, 30), kinds=9)
        texts.append(f"{prose(n + 99, 20)} {' '.join([block] * rng.randint(2, 9))}\n{block[:40]}")
    docs = documents([*enumerate(texts), (3, texts[-1]), (None, texts[-2])])
    result = found(docs)
    small = {i: t for i, t in enumerate(texts) if len(t or "") < 30_000}
    for i, text in small.items():
        assert expected(text) in result[i]
    assert sorted(map(len, result.values()))[-2:] == [1, 2] and None in result
    (runs, collapsed), = result[len(ODD) + 1]
    assert runs == [(0, 60_000, 1), (60_000, 100, 2)] and collapsed == "ab cd ef"
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def contract_row(doc_id, text):
    """The contract's columns in plain Python."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs, collapsed = expected(b" ".join(words).decode())
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    shown = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed)]
    return (doc_id, len(runs), *shown, *digests)


@pytest.mark.parametrize("partitions", [1, 5])
def test_query_columns(documents, prose, partitions):
    texts = [*ODD, *[prose(n, 10 + n % 90, kinds=20) for n in range(250)], "a b " * 40 + "c " * 60]
    docs = documents(list(enumerate(texts))).repartition(partitions)
    result = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(docs)))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"
    assert result.columns == names.split()
    want = sorted(contract_row(i, t) for i, t in enumerate(texts))
    assert sorted(tuple(r) for r in result.collect()) == want
    assert sum(r[1] > 0 for r in want) > 10
