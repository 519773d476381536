"""Shingle join, repeats, language, quality and page templates: against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluicework.llm import (
    arrow,
    catalog,
    components,
    kneser_ney,
    page_template,
    ppm_language,
    run_length_index,
    shingle_join,
)
from sluicework.llm.bit_filter import BitFilter
from sluicework.sources.storage import Staging, exists, shuffles_dropped

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", "   \n\t", "word", "é漢字 \U0001f600 a\x00b", "x" * 3000 + " " + "long " * 4000]


@pytest.fixture
def staging(spark):
    with Staging(spark) as opened:
        yield opened


def stored(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# Components


def roots(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_chains_stars_and_random_links(spark, staging):
    rng = random.Random(3)
    pairs = [(n, n + 1) for n in range(100, 160)] + [(500, 501 + n) for n in range(60)]
    pairs += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(90)]
    pairs += [(7, 7), (9, 8), (8, 9)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r["node"]: r["label"] for r in components.components(links, staging).collect()}
    assert found == {x: r for x, r in roots(pairs).items() if x != 7}
    assert components.components(links.limit(0), staging).count() == 0


# Shingle join


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(docs):
    sets = [shingles(text) for _, text in docs]
    holders, links = defaultdict(list), []
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        links += [
            (i, j) for j, n in shared.items() if 100 * n >= 80 * (len(own) + len(sets[j]) - n)
        ]
        for s in own:
            holders[s].append(i)
    root = roots([*links, *((i, i) for i in range(len(docs)))])
    least = {}
    for i, r in root.items():
        if docs[i][0] is not None:
            least[r] = min(least.get(r, math.inf), docs[i][0])
    return sorted(
        ((docs[i][0], len(sets[i]), least.get(root[i]) if sets[i] else docs[i][0])
         for i in range(len(docs))),
        key=repr,
    )


def near_copies(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("common", "tile"), [(8, 512), (2, 3)])
def test_components_of_near_copies_against_brute_force(documents, prose, monkeypatch, common, tile):
    monkeypatch.setattr(shingle_join, "COMMON_AT_LEAST", common)
    monkeypatch.setattr(shingle_join, "TILE", tile)
    rng = random.Random(5)
    docs = [(n, t) for n, t in enumerate(ODD)]
    passage = prose(77, 40)
    for n in range(12):
        base = prose(n, rng.randint(12, 260), kinds=5000)
        for edits in (0, 0, 1, 2, 3, 4, 6):
            docs.append((100 + len(docs) * 7 % 991, near_copies(rng, base, edits)))
    docs += [(2000 + n, near_copies(rng, prose(500, 200, kinds=5000), rng.randint(0, 9)))
             for n in range(60)]
    docs += [(3000 + n, f"{passage} {prose(900 + n, 60, kinds=5000)}") for n in range(40)]
    docs += [(None, prose(3, 50, kinds=5000)), (None, "all alone"), (3000, prose(4, 90, kinds=5000))]
    docs += [(4000, "one two"), (4001, "ONE\ttwo"), (4001, "ONE\ttwo"), (4002, "two one")]
    found = shingle_join.shingle_components(documents(docs))
    expected = brute_components(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    kept = shingle_join.keep_first(documents(docs))
    assert kept.columns == documents(docs).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    heads = {i for i, _, c in expected if i is not None and i == c}
    assert {i for i in ids if i is not None} == heads
    assert all(n == 1 for i, n in ids.items() if i is not None) and ids[None] == 2


def test_one_hot_group_of_near_copies(documents, prose):
    """A third of all rows are copies of one text, half of them edited."""
    rng = random.Random(9)
    base = prose(1, 120, kinds=4000)
    docs = [(n, near_copies(rng, base, n % 2 * rng.randint(1, 4))) for n in range(300)]
    docs += [(1000 + n, prose(10_000 + n, 80, kinds=4000)) for n in range(600)]
    found = shingle_join.shingle_components(documents(docs))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_components(docs)


def test_shingle_join_of_nothing(documents):
    nothing = documents([(1, "a")]).limit(0)
    assert shingle_join.shingle_components(nothing).count() == 0
    assert shingle_join.keep_first(nothing).count() == 0


def test_a_pair_goes_out_in_the_group_of_its_least_common_end():
    node, n = np.array([7, 8]), np.array([40, 40], np.int32)
    maps = [shingle_join.bitmap(np.arange(40, dtype=np.uint64))] * 2
    ends = np.array([[1, 2, 3, 4], [9, 4, 3, 2]])
    for token, out in ((2, 1), (3, 0), (4, 0), (None, 0)):
        assert len(shingle_join._pairs_in_group(node, n, node, maps, None, ends, token)) == out
        if token is not None:
            group = (node, n, node, maps, np.array([5, 5]), ends, token)
            assert len(shingle_join._leader_pairs(*group)) == out
    apart = np.array([[1, 1, 1, 1], [2, 2, 2, 2]])
    assert len(shingle_join._pairs_in_group(node, n, node, maps, None, apart)) == 1


def test_a_worker_gives_back_what_a_task_has_freed():
    """Arrays freed between kept ones stay in the heap until it is trimmed."""

    def heap():
        found = Path("/proc/self/smaps_rollup").read_text()
        return int(re.search(r"\nAnonymous:\s+(\d+)", found)[1]) >> 10

    held = [np.ones(8_000) for _ in range(4_000)]
    kept = held[::200]
    del held
    before = heap()
    arrow.give_back()
    assert heap() < before - 150 and len(kept) == 20


def test_shingle_join_sends_a_pair_from_its_first_shared_shingle_only(spark):
    # Nodes 1 and 2 share the shingles 5, 9 and 7, in this order; node 3 has the last one.
    rows = [(5, 1, 30, 1, 30), (9, 1, 30, 1, 28), (7, 1, 30, 1, 27), (4, 2, 30, 2, 30)]
    rows += [(5, 2, 30, 2, 29), (9, 2, 30, 2, 28), (7, 2, 30, 2, 27), (7, 3, 30, 3, 29)]
    maps = bytes(shingle_join.bitmap(np.arange(30, dtype=np.uint64)))
    nodes = [(i, 30, 1, maps, np.arange(10 * i, 10 * i + 4).tobytes()) for i in (1, 2, 3)]
    rows = spark.createDataFrame(rows, shingle_join._ROW).repartition(4, "node")
    near = shingle_join._with_before(rows)
    found = {(r["token"], r["node"]): r["before"] for r in near.collect()}
    assert found[5, 1] == [] and found[7, 1] == [5, 9] and found[7, 2] == [4, 5, 9]
    assert len(found) == 8
    for token, pairs in ((5, [(2, 1)]), (9, []), (7, [(3, 1), (3, 2)])):
        of = sorted(i for t, i in found if t == token)
        ids, n = np.array(of), np.full(len(of), 30)
        out = shingle_join._pairs_in_group(
            ids, n, ids, [maps] * len(of), None, np.array([[10 * i] for i in of]),
            left=n, before=[found[token, i] for i in of],
        )
        assert sorted((a, b) for a, _, b, _ in out) == pairs
    signatures = spark.createDataFrame(
        nodes, "node bigint, n int, weight int, bitmap binary, ends binary"
    )
    sent = shingle_join._candidate_pairs(rows, signatures, "all", None)
    assert {(r["a"], r["b"]) for r in sent.collect()} == {(1, 2), (1, 3), (2, 3)}


def test_a_staged_query_leaves_no_shuffle_files(spark, staging):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    def wait_for(done):
        for _ in range(50):
            if done(left := {f for f in files() if f.startswith("shuffle_")} - before):
                break
            time.sleep(0.1)
        return left

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(key, None), files()
    with shuffles_dropped(spark):
        counted = spark.range(50_000).groupBy((F.col("id") % 7_000).alias("k")).count()
        assert staging.table(counted).count() == 7_000
        assert not wait_for(lambda left: not left)
    assert spark.conf.get(key, None) == set_before


def test_shingle_join_drops_its_first_tables(spark, documents, monkeypatch):
    roots = []

    class Recorded(Staging):
        def __init__(self, session):
            super().__init__(session)
            roots.append(self.root)

    monkeypatch.setattr(shingle_join, "Staging", Recorded)
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, text), (2, text + " more"), (3, "other words")])
    found = shingle_join.shingle_components(docs)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3}
    assert len(roots) == 2 and [exists(spark, r) for r in roots] == [True, False]


def test_shingle_join_sends_little_with_a_row_of_the_last_round(spark, monkeypatch):
    """Neither the packed ends nor more than a few shingles before the row's own."""
    shared = 20
    rows = [(t, i, 100, i, 100 - t) for i in (1, 2) for t in range(shared)]
    rows = spark.createDataFrame(rows, shingle_join._ROW)
    assert max(len(r["before"]) for r in shingle_join._with_before(rows).collect()) <= 8
    maps = bytes(shingle_join.bitmap(np.arange(100, dtype=np.uint64)))
    nodes = [(i, 100, 1, maps, np.arange(10 * i, 10 * i + 4).tobytes()) for i in (1, 2)]
    nodes = spark.createDataFrame(
        nodes, "node bigint, n int, weight int, bitmap binary, ends binary"
    )
    kept = []
    whole = shingle_join.map_batches
    monkeypatch.setattr(
        shingle_join, "map_batches", lambda f, *a: kept.append(f.columns) or whole(f, *a)
    )
    sent = shingle_join._candidate_pairs(rows, nodes, "all", None)
    assert [tuple(r) for r in sent.collect()] == [(1, 100, 2, 100)]
    assert "before" in kept[0] and not {"ends", "weight"} & set(kept[0])


def test_driver_gets_packed_numbers_and_gives_memory_back(spark, monkeypatch):
    sizes = []
    frame = type(spark.range(1))
    fetch = frame.toArrow

    def measured(self):
        found = fetch(self)
        sizes.append(found.nbytes / max(found.num_rows, 1))
        return found

    monkeypatch.setattr(frame, "toArrow", measured)
    codes = spark.range(kneser_ney.SYMBOLS**kneser_ney.ORDER)
    base = kneser_ney._base(codes.select(F.col("id").alias("code"), (F.col("id") / 3).alias("p")))
    assert base[6] == 2 and base[-1] == np.float32((len(base) - 1) / 3)
    numbers = BitFilter(spark.range(-5_000, 5_000).select((F.col("id") * 977).alias("v")), "v")
    assert numbers.holds(np.arange(-5_000, 5_000) * 977).all() and not numbers.holds(np.array([5]))
    assert max(sizes) < 13
    assert arrow.give_back_driver(spark)


@pytest.mark.parametrize("neighbours", [2, 32])
def test_shingle_join_rows_with_a_partner(monkeypatch, neighbours):
    monkeypatch.setattr(shingle_join, "NEIGHBOURS", neighbours)
    rng = np.random.default_rng(3)
    for _ in range(20):
        group, n = np.sort(rng.integers(0, 6, 40)), rng.integers(10, 40, 40)
        n = n[np.lexsort((n, group))]
        label, end = rng.integers(0, 3, 40), rng.random(40) < 0.5
        left = n - rng.integers(0, 8, 40)
        exact = np.array([
            any(
                group[i] == group[j] and label[i] != label[j] and not (end[i] and end[j])
                and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j])
                and 9 * min(left[i], left[j]) >= 4 * (n[i] + n[j])
                for j in range(40)
            )
            for i in range(40)
        ])
        found = shingle_join._has_partner(group, n, label, left, end)
        assert (found >= exact).all()
        if neighbours == 32:
            assert (found == exact).all() and not found.all()


def test_components_of_a_long_chain_settle(spark, staging):
    links = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(links, staging)
    assert found.filter("label = 0").count() == 3001


def test_bitmap_bound_loses_no_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)
        a, b = (np.unique(pool[rng.random(len(pool)) < share]) for share in rng.uniform(0.6, 1, 2))
        a, b = sorted((a, b), key=len)
        if not len(a) or 5 * len(a) < 4 * len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            n = np.array([len(a), len(b)])
            ids = np.array([1, 2])
            maps = [shingle_join.bitmap(a), shingle_join.bitmap(b)]
            assert shingle_join._pairs_in_group(ids, n, ids, maps, None)


# Repeated strings


def brute_repeats(docs, window):
    first = {}
    order = sorted(docs, key=lambda d: (-math.inf if d[0] is None else d[0]))
    for doc_id, text in order:
        raw = (text or "").encode()
        for i in range(len(raw) - window + 1):
            key = (-math.inf if doc_id is None else doc_id, i)
            first[raw[i : i + window]] = min(first.get(raw[i : i + window], key), key)
    out = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - window + 1):
            if first[raw[i : i + window]] < (-math.inf if doc_id is None else doc_id, i):
                gone[i : i + window] = True
        gone = gone[: len(raw)]
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("crowd", "index_bytes"), [(2000, 1 << 20), (3, 4000)])
def test_repeats_against_brute_force(documents, prose, monkeypatch, crowd, index_bytes):
    monkeypatch.setattr(run_length_index, "GROUP_CONTEXTS", crowd)
    monkeypatch.setattr(run_length_index, "SLICE_BYTES", 3000 if crowd == 3 else 2 << 20)
    monkeypatch.setattr(run_length_index, "INDEX_BYTES", index_bytes)
    rng = random.Random(11)
    passages = [prose(n, 40) for n in range(6)]
    docs = list(enumerate(ODD))
    for n in range(60):
        parts = [prose(1000 + n, rng.randint(0, 60)), rng.choice(passages), rng.choice(passages)]
        rng.shuffle(parts)
        docs.append((500 - n * 7 % 241, " ".join(parts)))
    docs += [(900 + n, near_copies(rng, prose(70, 90), 2)) for n in range(20)]
    docs += [(950, "ab" * 300), (951, "a" * 400), (952, "ab" * 100), (None, passages[0])]
    docs += [(960, prose(71, 80)), (960, prose(71, 80)), (961, "z" * 99), (962, "z" * 99)]
    seen = set()
    docs = [d for d in docs if d[0] in (None, 960) or not (d[0] in seen or seen.add(d[0]))]
    found = run_length_index.digest(run_length_index.remove_repeats(documents(docs)))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_repeats(docs, 100)
    nothing = run_length_index.remove_repeats(documents([(1, "a")]).limit(0))
    assert nothing.count() == 0


def test_index_finds_repeats_within_and_between_contexts():
    rng = random.Random(5)
    for _ in range(40):
        letters = rng.choice([b"ab", b"abcdefghijklmnop", b"a"])
        base = bytes(rng.choice(letters) for _ in range(400))
        contexts = []
        for _ in range(rng.randint(1, 12)):
            begin = rng.randint(0, 250)
            one = bytearray(base[begin : begin + rng.randint(100, 170)])
            if rng.random() < 0.5:
                one[rng.randrange(len(one))] = rng.choice(letters + b"z\0")
            contexts.append(bytes(one))
        seen, expected = set(), []
        for one in contexts:
            again = []
            for k in range(len(one) - 99):
                if one[k : k + 100] in seen:
                    again.append(k)
                seen.add(one[k : k + 100])
            expected.append(again)
        found = [x.tolist() for x in run_length_index.repeated_windows(contexts)]
        assert found == expected


def test_anchors_seldom_recur_by_chance(prose):
    text = prose(5, 100_000, kinds=40).encode()
    texts = [text[k : k + 2000] for k in range(0, len(text), 2000)]
    seen = [found.anchor for found in map(run_length_index.stretches, [[t] for t in texts])]
    found = run_length_index.stretches(texts)
    assert np.array_equal(np.concatenate(seen), found.anchor)
    _, times = np.unique(found.anchor, return_counts=True)
    assert times[times > 1].sum() < len(found.anchor) / 100


def test_index_takes_contexts_that_share_a_side(monkeypatch):
    rng = random.Random(8)

    def letters(n):
        return bytes(rng.choice(b"abcdefgh") for _ in range(n))

    # A phrase that recurs within ever new text, and passages long enough to hold equal windows.
    phrase, passages = letters(50), [letters(130), letters(170)]
    texts = [letters(150) + phrase + letters(150) for _ in range(200)]
    for n in range(12):
        texts[n * 7] += passages[n % 2] + letters(90)
    texts += [texts[3], texts[3][:250] + letters(60)]
    found = run_length_index.stretches(texts)
    order = np.lexsort((found.first, found.text, found.anchor))
    spots = [tuple(int(x[i]) for x in found) for i in order]
    rows = [
        (key, 0, t, t + 1000, a, b, place - a, texts[t][a : b + 100])
        for t, key, _, a, b, place in spots
    ]
    types = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
    names = ["key", "more", "doc_id", "text_key", "first", "last", "at", "context"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=names)

    indexed = []
    plain = run_length_index.repeated_windows
    monkeypatch.setattr(
        run_length_index, "repeated_windows", lambda c: indexed.extend(c) or plain(c)
    )
    expected, seen = set(), set()
    for t, text in enumerate(texts):
        expected |= {(t, k) for k in range(len(text) - 99) if text[k : k + 100] in seen}
        seen |= {text[k : k + 100] for k in range(len(text) - 99)}
    for size in (1 << 20, 2000):
        monkeypatch.setattr(run_length_index, "INDEX_BYTES", size)
        monkeypatch.setattr(run_length_index, "TAKEN_BYTES", size)
        groups, got = run_length_index._Groups(), set()
        parts = [p for b in range(0, len(rows), 100) for p in groups.take(batch.slice(b, 100))]
        for part in (*parts, *groups.close()):
            places = zip(part["doc_id"].to_pylist(), part["first"], part["last"], strict=True)
            got |= {(t, k) for t, a, b in places for k in range(a, b + 1)}
        assert got == expected
    phrases = sum(phrase in c for c in (r[-1] for r in rows))
    assert phrases > 200 > 20 > sum(phrase in c for c in set(indexed))


def test_filter_grows_with_the_count(spark):
    frame = spark.range(1000).withColumnRenamed("id", "v")
    small, large = BitFilter(frame, "v"), BitFilter(frame, "v", 20_000_000)
    others = np.arange(1000) + (1 << 26)
    assert small.holds(np.arange(1000)).all() and large.holds(np.arange(1000)).all()
    assert small.holds(others).all() and not large.holds(others).any()


def test_runs_are_fewer_than_bytes_in_repetitive_text():
    one = bytes(random.Random(1).choice(b"abcdefgh") for _ in range(150))
    text = np.frombuffer(b"\0".join([one] * 40 + [b""]), np.uint8)
    breaks = np.arange(1, 41) * 151 - 1
    index = run_length_index.RunLengthIndex(text, breaks, 151)
    assert len(index.run_starts) < len(text) / 10


# Language


def brute_code_length(text, counts):
    """Bits of a text under nested dictionaries of what followed each context."""
    bits, raw = 0.0, bytes(ppm_language.ORDER) + text
    for i in range(ppm_language.ORDER, len(raw)):
        chance = 1 / 256
        for k in range(ppm_language.ORDER + 1):
            seen = counts.get(raw[i - k : i])
            if seen:
                n, q = sum(seen.values()), len(seen)
                chance = seen[raw[i]] / (n + q) if raw[i] in seen else chance * q / (n + q)
        bits -= math.log2(chance)
    return bits


def test_code_lengths_against_dictionaries(prose):
    learnt = [prose(n, 60).encode() for n in range(4)] + ["été où".encode()]
    counts = defaultdict(Counter)
    for text in learnt:
        raw = bytes(ppm_language.ORDER) + text
        for i in range(ppm_language.ORDER, len(raw)):
            for k in range(ppm_language.ORDER + 1):
                counts[raw[i - k : i]][raw[i]] += 1
    grams, n = np.unique(ppm_language.gram_codes(learnt)[0], return_counts=True)
    scorer = ppm_language.Scorer([ppm_language.tree(grams, n.astype(float))])
    texts = [prose(2, 30).encode(), prose(90, 30).encode(), b"", b"x", "où ça".encode(), b"\0\0zz"]
    found = scorer.lengths(texts)[:, 0]
    expected = [brute_code_length(t, counts) for t in texts]
    assert np.allclose(found, expected, rtol=1e-4)


def test_language_of_held_out_documents(spark):
    docs = stored(spark, "documents")
    found = ppm_language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert all(share > 0.97 for _, share in right.collect())
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    assert found.filter(F.col("held_out") != fold).count() == 0


def test_language_uses_no_label_of_its_own_and_takes_odd_rows(documents):
    docs = [(n, "le chat est la " * 5, "fr") for n in range(20)]
    docs += [(50 + n, "der hund ist das " * 5, "de") for n in range(20)]
    docs += [(100 + n, t, None) for n, t in enumerate(ODD)]
    docs += [(200, "das ist der hund", "fr"), (None, "la le chat", "xx"), (201, "123 ...", "fr")]
    found = {r["doc_id"]: r for r in ppm_language.identify(documents(docs)).collect()}
    assert found[200]["lang_pred"] == "de" or found[200]["held_out"] is False
    assert found[None]["lang_pred"] == "fr" and found[None]["held_out"] is False
    for doc_id in (100, 101, 102, 201):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in found.values()) and len(found) == len(docs)
    unlabelled = ppm_language.identify(documents([(1, "a b", None)])).first()
    assert unlabelled["lang_pred"] == "und"
    assert ppm_language.identify(documents([(1, "a")]).limit(0)).count() == 0


# Quality


def test_probabilities_are_those_of_the_formula(spark, staging, prose):
    """Interpolated modified Kneser-Ney by nested dictionaries, for every seen and some unseen."""
    texts = [prose(n, 60) for n in range(3)]
    codes, _ = kneser_ney.gram_codes([t.encode() for t in texts])
    size, order = kneser_ney.SYMBOLS, kneser_ney.ORDER
    levels = {order: Counter(codes.tolist())}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(code % size**k for code in levels[k + 1])

    def discounts(counts):
        of = Counter(counts.values())
        if not (of[1] and of[2] and of[3]):
            return [0.5, 1.0, 1.5]
        y = of[1] / (of[1] + 2 * of[2])
        found = [i - (i + 1) * y * of[i + 1] / of[i] for i in (1, 2, 3)]
        return [d if 0 <= d <= i else i / 2 for i, d in zip((1, 2, 3), found, strict=True)]

    taken = {k: discounts(c) for k, c in levels.items()}

    def chance(code, k):
        if not k:
            return 1 / size
        context = [c for c in range(code // size * size, code // size * size + size)]
        counts = [levels[k][c] for c in context if levels[k][c]]
        lower = chance(code % size ** (k - 1), k - 1)
        if not counts:
            return lower
        off = [taken[k][min(n, 3) - 1] for n in counts]
        own = levels[k][code] - (taken[k][min(levels[k][code], 3) - 1] if levels[k][code] else 0)
        return own / sum(counts) + sum(off) / sum(counts) * lower

    docs = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    table = kneser_ney.probabilities(spark, kneser_ney.gram_counts(docs), staging).toPandas()
    found = dict(zip(table["code"], table["p"], strict=True))
    assert len(found) == size**order
    for code in [*list(levels[order])[:300], *range(0, size**order, 9973)]:
        assert found[code] == pytest.approx(chance(code, order), rel=1e-9)
    sums = table.groupby(table["code"] // size)["p"].sum()
    assert np.allclose(sums, 1.0)


def test_perplexity_is_of_unfolded_bytes_against_dictionaries(spark, documents, prose, monkeypatch):
    """Every order of bytes by dictionaries, over the class model; slices of many sizes."""
    monkeypatch.setattr(kneser_ney, "LEAST_SLICES", 3)
    monkeypatch.setattr(kneser_ney, "SLICE_BYTES", 700)
    monkeypatch.setattr(kneser_ney, "COUNTED_GRAMS", 50)
    learnt = [(n, prose(n, 60) + " room 101 Berlin é") for n in range(12)]
    same = [(100, "room 101 Berlin"), (101, "room 735 bERLIN"), (102, "Room 101 Ber\U0001f600"), (103, "q")]
    docs = learnt + same + [(200, ""), (201, None)]
    labels = spark.createDataFrame([(n, 1, 0) for n, _ in learnt], "doc_id int, quality int, toxic int")
    found = {r["doc_id"]: r["perplexity"] for r in kneser_ney.classify(documents(docs), labels).collect()}
    fold = {r["doc_id"] for r in kneser_ney._trusted(labels).filter("calibration").collect()}
    trained = [t for n, t in learnt if n not in fold]
    order = kneser_ney.BYTE_ORDER
    grams = Counter()
    for text in trained:
        raw = b" " * (order - 1) + text.encode()
        grams.update(raw[i : i + order] for i in range(len(raw) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    off, totals, left = {}, {}, {}
    for k, counts in levels.items():
        of = Counter(counts.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] and of[3] else None
        exact = [i - (i + 1) * y * of[i + 1] / of[i] for i in (1, 2, 3)] if y is not None else [-1] * 3
        off[k] = [d if 0 <= d <= i else i / 2 for i, d in zip((1, 2, 3), exact, strict=True)]
        totals[k], left[k] = Counter(), Counter()
        for g, n in counts.items():
            totals[k][g[:-1]] += n
            left[k][g[:-1]] += off[k][min(n, 3) - 1]
    frame = spark.createDataFrame([(t,) for t in trained], "text string")
    with Staging(spark) as staging:
        table = kneser_ney.probabilities(spark, kneser_ney.gram_counts(frame), staging).toPandas()
    base = dict(zip(table["code"], table["p"], strict=True))

    def chance(gram, k):
        if not k:
            code = 0
            for byte in gram[-kneser_ney.ORDER :]:
                code = code * kneser_ney.SYMBOLS + int(kneser_ney.CLASSES[byte])
            return base[code] / (kneser_ney.CLASSES == kneser_ney.CLASSES[gram[-1]]).sum()
        own, lower = gram[-k:], chance(gram, k - 1)
        total = totals[k][own[:-1]]
        if not total:
            return lower
        n = levels[k][own]
        return (n - (off[k][min(n, 3) - 1] if n else 0)) / total + left[k][own[:-1]] / total * lower

    for doc_id, text in docs:
        if not text:
            assert found[doc_id] is None
            continue
        raw = b" " * (order - 1) + text.encode()
        costs = [-math.log2(chance(raw[i : i + order], order)) for i in range(len(raw) - order + 1)]
        assert found[doc_id] == pytest.approx(2 ** (sum(costs) / len(costs)), rel=1e-4)
    assert found[101] > 2 * found[100]


def test_a_block_is_made_into_ngrams_in_small_parts(prose):
    """A worker holds several numbers per byte of a part, so a part is 1 MiB of text at most."""
    texts = [prose(n, 3000) for n in range(300)]
    assert sum(map(len, texts)) > 4 << 20
    table = pa.table({"doc_id": range(300), "text": texts})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    parts = list(kneser_ney._chunks(sink.getvalue().to_pybytes()))
    assert [i for rows, _, _ in parts for i in rows["doc_id"].to_pylist()] == [*range(300)]
    assert max(len(codes) for _, codes, _ in parts) <= 1 << 20


def test_quality_keeps_trusted_text_and_drops_noise(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(kneser_ney, "LEAST_CALIBRATION", 5)
    docs = [(n, prose(n, 80), "en" if n % 2 else "de") for n in range(200)]
    docs += [(300 + n, "$$$ %%% ### " * 40 + str(n), "en") for n in range(10)]
    docs += [(400 + n, t, None) for n, t in enumerate(ODD)]
    docs += [(None, prose(3, 60), "de"), (5, "again another " * 9, "en")]
    marks = [(n, 1, 0) for n in range(150)] + [(301, 0, 0), (3, 1, 1), (None, 1, 0), (7, 1, None)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    found = kneser_ney.classify(documents(docs), labels).collect()
    assert len(found) == len(docs)
    kept = defaultdict(list)
    for row in found:
        kept[row["doc_id"]].append(row["kept"])
    assert sum(kept[n][0] for n in range(200)) >= 190
    assert not any(kept[300 + n][0] for n in range(10))
    assert kept[400] == kept[401] == [False]
    left = kneser_ney.keep_good(documents(docs), labels)
    assert left.columns == documents(docs).columns
    assert left.count() == sum(row["kept"] for row in found)
    untrusted = kneser_ney.classify(documents(docs), labels.limit(0)).collect()
    assert [r["kept"] for r in untrusted if r["doc_id"] in (400, 401, 403)] == [False, False, True]
    assert kneser_ney.classify(documents(docs).limit(0), labels).count() == 0


def test_held_out_labels_are_told_apart(spark):
    found = kneser_ney.classify(stored(spark, "documents"), stored(spark, "labels"))
    shares = dict(
        found.join(stored(spark, "labels"), "doc_id")
        .filter("toxic = 0")
        .groupBy("quality")
        .agg(F.avg(F.col("kept").cast("int")))
        .collect()
    )
    assert shares[1] > 0.95 and shares[0] < 0.5


# Pages


def page(body, title="t"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>var a='<p>no</p>';</script>"
        f"<style>p{{}}</style></head><body>{body}</body></html>"
    )


def test_blocks_references_and_roles():
    body = (
        "<header>h</header><nav><ul><li>menu</ul></nav><!-- <p>c</p> --><div class='cookie-notice'>n"
        "</div><article><h1>Head &amp; line</h1><p>One&nbsp;two<br>three  <b>four</p><p>un<i>clo</i>sed"
        "<p>next<div class='ad'>buy</div><ul><li>a<li>b</ul><form>f</form>"
        "<section id=comments><p>me too</section><p>&lt;end&gt; &#233;</article><footer>f</footer>"
    )
    assert page_template.extract(page(body), frozenset(), None).split("\n") == [
        "Head & line", "One two three four", "unclosed", "next", "a", "b", "<end> é",
    ]
    for odd in ("", "<", "a < b", "<p", "<!--", "<script>", "</div>x", '<a href="', "<p>" * 500):
        page_template.extract(odd, frozenset(), None)
    assert page_template.extract("plain &amp; text", frozenset(), None) == "plain & text"
    assert page_template.extract(page("<p>cut of"), frozenset(), None) == "cut of"


def test_roles_on_and_around_the_article_do_not_empty_a_page():
    article, small = "<article><p>One two three</p><div class='ad'>buy</div></article>", "<p>small</p>"
    bodies = [
        f"<main class='sidebar-left'>{article}</main>", f"<form id='search'>{article}</form>{small}",
        f"<div class='widget'><div class='banner'>{article}</div></div>",
        article.replace("<article>", "<article class='post has-sidebar'>"),
        f"{article}<section id='comments'><article class='comment'><p>{'me too ' * 9}</p></article></section>",
    ]
    for body in bodies:
        for names in ("", " class='nav-open no-banner'"):
            whole = f"<html{names}><head><title>t</title></head><body{names}>{body}</body></html>"
            assert page_template.extract(whole, frozenset(), None) == "One two three"
    promo = "<aside><article><p>promo</p></article></aside><div><p>One two three</p></div>"
    assert page_template.extract(page(promo), frozenset(), None) == "One two three"
    plain = "<body class='nav-open'><p>only</p></body>"
    assert page_template.extract(plain, frozenset(), None) == "only"


def test_template_finds_constants_and_the_main_slot(spark, prose):
    rows = []
    for n in range(40):
        text = "".join(f"<p>{prose(n * 10 + k, 30)}</p>" for k in range(3))
        body = (
            f"<div class='top'><p>Welcome to our site</p></div><div class='box'><p>{prose(n, 4)}</p>"
            f"</div><div class='story'><p>Share this story</p>{text}</div><div class='end'>The end</div>"
        )
        rows.append((n, "https://Site.example/a?b" if n % 3 else "http://site.example:80/x", page(body)))
    rows += [(100, None, None), (101, "no url", ""), (102, "http://one.example/", page("<p>only</p>"))]
    rows += [(0, "https://site.example/again", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = pages.withColumn("host", F.lit("x")).withColumn("main_slot", F.lit(1))
    found = page_template.main_text(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["page_id"] < 40:
            n = row["page_id"]
            assert row["text"] == "\n".join(prose(n * 10 + k, 30) for k in range(3))
        assert row["n_chars"] == len(row["text"])
    texts = {r["page_id"]: r["text"] for r in found}
    assert (texts[100], texts[101], texts[102]) == ("", "", "only")
    assert page_template.main_text(pages.limit(0)).count() == 0


def test_an_article_keeps_what_it_shares_with_others(spark):
    shared = "<h1>News of the day</h1><p>First shared words.</p><p>Second shared words.</p>"
    rows = [
        (n, "https://a.example/", page(f"<nav>menu</nav><article>{shared}<p>Only {n} differs.</p></article>"))
        for n in range(8)
    ]
    found = page_template.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    want = "News of the day\nFirst shared words.\nSecond shared words.\nOnly %d differs."
    assert {r["page_id"]: r["text"] for r in found.collect()} == {n: want % n for n in range(8)}


def test_a_class_name_has_the_role_of_its_head():
    body = "<div class='search-results-story'><p>Found at last</p></div>"
    assert page_template.extract(page(body), frozenset()) == "Found at last"
    body = (
        "<article><p>One</p><div class='tags-of-history'>Two</div><blockquote class='notice-quote'>"
        "Three</blockquote><div class='cookieNotice'>x</div><div id='ad-300x250'>x</div>"
        "<ul class='comment-list'><li>x</ul><div class='content has-sidebar'>Four</div></article>"
    )
    assert page_template.extract(page(body), frozenset()) == "One\nTwo\nThree\nFour"


def _layouts(prose, hosts=3, pages=24):
    """Hosts of two even layouts without an article, one of them with banner lines in the slot."""
    rows = []
    for host in range(hosts):
        for n in range(pages):
            k = 1000 * host + 10 * n
            text = "".join(f"<p>{prose(k + i, 12)}</p>" for i in range(1 + n % 3))
            if n % 2:
                body = f"<div class='story'><p>Banner of {host}</p><p>Line two</p>{text}</div><b>end</b>"
            else:
                body = (
                    f"<table class='frame'><tr><td>Links</td></tr></table><div class='page'><div class"
                    f"='lead'>{text}</div><div class='more'><h2>{prose(k + 7, 3)}</h2></div></div>"
                )
            if n % 5 == 0:
                body += f"<div class='extra'><p>{prose(k + 8, 2)}</p></div>"
            rows.append((len(rows), f"https://h{host}.example/{n}", page(body, f"title {n}")))
    rows.append((len(rows), rows[1][1], rows[1][2]))
    return rows


def test_each_of_two_even_layouts_has_its_template(spark, prose):
    rows = _layouts(prose)
    found = page_template.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    for row in found.collect():
        host, n = divmod(row["page_id"], 24) if row["page_id"] < 72 else (0, 1)
        k = 1000 * host + 10 * n
        want = [prose(k + i, 12) for i in range(1 + n % 3)]
        assert row["text"].split("\n")[: len(want)] == want
        assert "Banner" not in row["text"] and "Links" not in row["text"]


def test_classes_and_slots_equal_brute_force(spark, prose, staging):
    """Vectors held in full, classes by comparing them, slots by adding up page after page."""
    rows = _layouts(prose)
    rows += [(n, "https://few.example/", page(f"<div class='a'>same</div><p>{n}</p>")) for n in range(900, 904)]
    rows += [(n, "https://same.example/", page("<div class='a'>same</div>")) for n in range(910, 920)]
    hosts = {}
    for n, url, text in rows:
        hosts.setdefault(url.split("/")[2], []).append((n, page_template.parse(text)))
    want, templates = {}, {}
    for host, parsed in hosts.items():
        vectors, holder, held, seen = {}, {}, {}, {}
        for n, (blocks, opened) in parsed:
            own = "\n".join(b.text for b in blocks)
            for path, times in opened.items():
                vectors.setdefault(("element", path), {})[n] = times
                seen.setdefault(("element", path), set()).add(own)
            for b in blocks:
                token = ("text", b.path, b.text)
                vector = vectors.setdefault(token, {})
                vector[n] = vector.get(n, 0) + 1
                seen.setdefault(token, set()).add(own)
                holder[token] = b.path.rpartition("/")[0]
                if not b.other:
                    held.setdefault(holder[token], []).append((n, token, len(b.text), own))
        def frequent(pages, own):
            return len(pages) >= 5 and 100 * len(pages) >= len(parsed) and len(own) > 1
        classes = {}
        for token, vector in vectors.items():
            if frequent(vector, seen[token]):
                classes.setdefault(frozenset(vector.items()), []).append(token)
        valid = [c for c in classes.values() if len(c) > 1 and any(t[0] == "element" for t in c)]
        constants = {t for c in valid for t in c if t[0] == "text"}
        slots = {}
        for path, texts in held.items():
            pages = {n for n, *_ in texts}
            if frequent(pages, {own for *_, own in texts}):
                slots[path] = sum(c for _, t, c, _ in texts if t not in constants) / len(pages)
        number = page_template._number
        if constants or slots or valid:
            templates[host] = (
                sorted(number(f"{p}\n{t}") for _, p, t in constants),
                {number(p): w for p, w in slots.items()}, len(valid),
            )
        known, weights, _ = templates.get(host, ([], {}, 0))
        for n, *_ in parsed:
            text = next(r[2] for r in rows if r[0] == n)
            want[n] = page_template.extract(text, frozenset(known), weights)
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = page_template.templates(frame.withColumn("host", F.split("url", "/")[2]), staging)
    assert {
        r["host"]: (r["constants"] or [], dict(zip(r["slots"] or [], r["weights"] or [])), r["n_classes"] or 0)
        for r in found.collect()
    } == templates
    assert {r["page_id"]: r["text"] for r in page_template.main_text(frame).collect()} == want


def test_templates_joined_by_shuffle_give_the_same(spark, monkeypatch):
    pages = stored(spark, "pages")
    one = {tuple(r) for r in page_template.main_text(pages).collect()}
    monkeypatch.setattr(page_template, "BROADCAST_ENTRIES", -1)
    assert {tuple(r) for r in page_template.main_text(pages).collect()} == one


def test_generated_pages_against_a_plain_cut(spark):
    import html

    found = page_template.main_text(stored(spark, "pages"))
    joined = found.join(stored(spark, "pages").select("page_id", "html"), "page_id").collect()
    for row in joined:
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b)


# The pipeline


def test_pipeline_stages_against_their_parts(spark, staging):
    docs, columns = stored(spark, "documents"), stored(spark, "documents").columns
    ids = {0: {r["doc_id"] for r in docs.collect()}}
    before = docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        after = staging.table(stage(spark, before, SF_DIR))
        rows = after.collect()
        ids[n] = {r["doc_id"] for r in rows}
        assert len(rows) == len(ids[n]) and ids[n] <= ids[n - 1]
        if n == 2:
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert ids[n] == {i for i, _, c in brute_components(texts) if i == c}
        if n == len(corpus_pipeline.STAGES):
            assert after.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            assert ids[n] == ids[n - 1]
        else:
            assert after.columns == columns
            before = after
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for row in rows:
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    final = corpus_pipeline.run(spark, SF_DIR)
    assert {tuple(r) for r in final.collect()} == {tuple(r) for r in rows}


def test_pipeline_over_odd_and_empty_tables(spark, documents, tmp_path):
    for name in ("labels", "benchmark"):
        stored(spark, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in ([*enumerate(ODD), (None, "null id"), (3, "word")], [(1, "a")]):
        docs = documents(rows) if len(rows) > 1 else documents(rows).limit(0)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.collect()


def test_every_operator_is_registered():
    names = list(catalog.queries())
    assert [re.match(r"op(\d+)_", n)[1] for n in names] == [str(n) for n in range(1, 11)]
