"""The Merkle manifest against a plain recomputation, and its proofs row by row."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluicework.llm import merkle_manifest
from sluicework.sources.storage import Staging

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """All levels above the nodes, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        begin = at // 8 * 8
        yield level[begin:at], level[at + 1 : begin + 8]
        at //= 8


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"], leaf(row, row["text"]), row))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = climb([h for _, h, _ in groups[name]])
    upper = climb([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, (doc_id, own, row) in enumerate(groups[name]):
            path = [*siblings(trees[name], at), *siblings(upper, place)]
            done, text = own, row["text"]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text:
                done = leaf(row, ascii_lower(text))
            for left, right in path:
                done = digest(*left, done, *right)
            root = upper[-1][0]
            proof = digest(*[h for left, right in path for h in (*left, *right)])
            subroot = trees[name][-1][0]
            out.append((doc_id, own, subroot, root, proof, done, done == root))
    return sorted(out, key=repr)


def found(docs):
    result = merkle_manifest.verified_manifest(docs)
    assert tuple(result.columns) == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=repr)


@pytest.fixture
def make(spark):
    def build(rows):
        values = [(*row, "x", 5, "y") for row in rows]
        return spark.createDataFrame(
            values,
            "doc_id bigint, source string, lang string, n_chars bigint, text string,"
            " hash string, place int, tree string",
        )

    return build


def test_manifest_of_uneven_languages(make):
    rng = random.Random(4)
    sizes = {"de": 1, "en": 513, "es": 8, "fr": 9, "it": 64, "nl": 65, None: 3, "": 2, "é": 17}
    ids = list(range(2000))
    rng.shuffle(ids)
    rows = [
        (ids.pop(), f"s{rng.randint(0, 3)}", lang, rng.randint(0, 9), f"Text {rng.random()} É")
        for lang, n in sizes.items()
        for _ in range(n)
    ]
    docs = make(rows).repartition(7)
    result = found(docs)
    assert result == expected([r.asDict() for r in docs.collect()])
    assert 0 < sum(not row[-1] for row in result) < len(result)


def test_nulls_ties_and_repeated_rows(make):
    rows = [
        (None, None, None, None, None),
        (None, "s", "en", 1, "A"),
        (0, "s", "en", 1, ""),
        (0, "s", "en", 1, None),
        (5, "s", "en", 3, "ABC"),
        (5, "s", "en", 3, "abc"),
        (-7, "\U0001f600:", "en", -3, "é漢 \x00 B" * 5000),
        *[(9, "s", "en", 1, "Same")] * 40,
    ]
    result = found(make(rows))
    assert result == expected([dict(zip(merkle_manifest.FIELDS, x, strict=True)) for x in (
        (r[0], r[1], r[2], r[3], r[4]) for r in rows)])


def test_no_row_and_one_row(make):
    assert found(make([(1, "s", "en", 1, "A")]).limit(0)) == []
    (row,) = found(make([(1, "s", "en", 1, "A")]))
    assert row[1] == row[2] == row[3] and row[4] == digest()


def test_a_changed_row_changes_its_own_subroot_and_the_root(make, spark):
    rows = [(n, "s", "en" if n % 3 else "fr", n, f"t{n}") for n in range(100)]
    with Staging(spark) as staging:
        before = merkle_manifest.build(make(rows), staging)
        rows[4] = (4, "s", "en", 4, "other")
        after = merkle_manifest.build(make(rows), staging)
        assert before.root != after.root
        one = {r["place"]: r["hash"] for r in before.subroots.collect()}
        two = {r["place"]: r["hash"] for r in after.subroots.collect()}
        assert one[0] != two[0] and one[1] == two[1]
        # A parent's row holds its children in slots.
        top = before.levels[0].filter("tree = 1 AND place = 0").first()
        first = before.leaves.filter("tree = 1 AND place < 8").orderBy("place").collect()
        assert [top[s] for s in merkle_manifest.SLOTS] == [r["hash"] for r in first]
        assert before.levels[0].filter(F.col("size") < 1).count() == 0
