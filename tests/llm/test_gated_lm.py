"""The recurrent language model: counts against plain ones, gradients and states against plain loops."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sluicework.llm import catalog, gated_lm

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " \t\n", "Word", "é漢 \x00 É", "x" * 5000 + " y" * 30_000]
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def check_base(rows, docs):
    """All columns but the score, against plain counting."""
    counts = Counter()
    for doc_id, text in docs:
        if fold(doc_id) not in (None, 0):
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for doc_id, text in docs:
        own = tokens(text)
        base = math.fsum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        want.append((doc_id, fold(doc_id) == 0, len(own), sum(counts[t] > 0 for t in own), total, base))
    want.sort(key=repr)
    got = sorted((tuple(r)[:-1] for r in rows), key=repr)
    assert [x[:-1] for x in got] == [x[:-1] for x in want]
    assert [x[-1] for x in got] == pytest.approx([x[-1] for x in want], rel=1e-9)


@pytest.mark.parametrize("slice_bytes", [1 << 24, 3000])
def test_counts_and_base_score(documents, prose, monkeypatch, slice_bytes):
    monkeypatch.setattr(gated_lm, "SLICE_BYTES", slice_bytes)
    docs = [*enumerate(ODD), (None, "word here"), (3, "Word"), (3, "Word")]
    docs += [(100 + n, prose(n, 10 + 7 * n % 300, kinds=900)) for n in range(60)]
    result = gated_lm.score(documents(docs).repartition(3))
    assert result.columns == COLUMNS
    rows = result.collect()
    check_base(rows, docs)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] == 3]
    assert same[0] == pytest.approx(same[1]) == pytest.approx(same[2])


def test_nothing_to_learn_from(documents):
    assert gated_lm.score(documents([(1, "a")]).limit(0)).collect() == []
    held = next(n for n in range(1000) if fold(n) == 0)
    rows = gated_lm.score(documents([(held, "a b"), (None, "c")])).collect()
    check_base(rows, [(held, "a b"), (None, "c")])
    assert all(r["n_known"] == r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)


def small_net(seed):
    rng = np.random.default_rng(seed)
    model = gated_lm.net(rng.normal(0, 0.3, sum(gated_lm.SIZES)))
    return rng, model


def test_gradient_against_differences():
    rng, model = small_net(1)
    window = rng.integers(0, gated_lm.SYMBOLS, (5, 4))
    window[2, 1] = window[3, 3] = gated_lm.END
    window[1:, 0] = [3, 40, 3, 41]
    state = rng.normal(0, 0.3, (4, gated_lm.STATE))
    gradient = gated_lm.net(np.zeros_like(model.flat))
    gated_lm.window_gradient(model, state, window, gradient)
    places = [*np.argsort(-np.abs(gradient.flat))[:40], *rng.integers(0, len(model.flat), 40)]
    for at in places:
        ends = []
        for step in (1e-5, -1e-5):
            moved = model.flat.copy()
            moved[at] += step
            spare = gated_lm.net(np.zeros_like(moved))
            ends.append(gated_lm.window_gradient(gated_lm.net(moved), state, window, spare)[0])
        assert gradient.flat[at] == pytest.approx(-(ends[0] - ends[1]) / 2e-5, abs=1e-6)


def plain_log_chance(model, text):
    """Symbol by symbol, from the first to the end."""
    h = np.zeros(gated_lm.STATE)
    total, s = 0.0, gated_lm.STATE
    for symbol in text:
        symbol = int(symbol)
        logits = h @ model.classes + model.class_bias
        head = 1 <= symbol <= gated_lm.HEAD
        tail = symbol - gated_lm.HEAD + gated_lm.HEAD_CLASSES
        of = 0 if symbol == 0 else (symbol - 1) // 32 + 1 if head else tail
        total += logits[of] - np.log(np.exp(logits).sum())
        if head:
            inner = h @ model.words[of - 1] + model.word_bias[of - 1]
            total += inner[(symbol - 1) % 32] - np.log(np.exp(inner).sum())
        x, g = model.inputs[symbol], h @ model.states
        z, r = (1 / (1 + np.exp(-(x[i : i + s] + g[i : i + s]))) for i in (0, s))
        h = z * h + (1 - z) * np.tanh(x[2 * s :] + r * g[2 * s :])
    return total


def test_state_goes_on_through_whole_texts_and_no_further(monkeypatch):
    monkeypatch.setattr(gated_lm, "SCORE_LANES", 5)
    rng, model = small_net(2)
    model.class_bias[:] *= 40  # logits that need their maximum taken off
    texts = []
    for n in [0, 0, 1, 3, 40, 41, 7, 300, 2, 16, 15, 17]:
        own = rng.integers(1, gated_lm.SYMBOLS, n)
        texts.append(np.append(own, gated_lm.END).astype(np.uint16))
    want = [plain_log_chance(model, t) for t in texts]
    assert gated_lm.log_chances(model, texts) == pytest.approx(want, rel=1e-6)
    assert len(gated_lm.log_chances(model, [])) == 0


def test_chances_of_all_symbols_sum_to_one():
    rng, model = small_net(3)
    every = np.arange(gated_lm.SYMBOLS)
    state = np.repeat(rng.uniform(-1, 1, (1, gated_lm.STATE)), len(every), 0)
    logp, _ = gated_lm._output(model, state, every)
    assert np.exp(logp).sum() == pytest.approx(1)


@pytest.mark.parametrize("n", [1, 7, 16, 5000, 9001])
def test_every_token_is_in_one_trained_window(monkeypatch, n):
    monkeypatch.setattr(gated_lm, "LANES", 8)
    seen, gradient = [], gated_lm.window_gradient

    def watched(model, state, window, into):
        seen.append(window)
        return gradient(model, state, window, into)

    monkeypatch.setattr(gated_lm, "window_gradient", watched)
    symbols = np.random.default_rng(n).integers(1, gated_lm.SYMBOLS, n)
    start = gated_lm.first_net(np.bincount(symbols, minlength=gated_lm.SYMBOLS).astype(float))
    gated_lm.Trainer(start.flat, gated_lm.RATE).learn(symbols)
    trained = np.concatenate(seen).T.ravel()
    assert (trained[:n] == symbols).all()
    assert (trained[n:] == gated_lm.END).all()


def test_training_learns_an_order_of_words():
    rng = random.Random(4)
    successor = {w: [rng.randint(1, 60) for _ in range(2)] for w in range(1, 61)}

    def text():
        out = [rng.randint(1, 60)]
        while len(out) < 50:
            out.append(rng.choice(successor[out[-1]]))
        return np.array([*out, gated_lm.END], np.uint16)

    learnt, held = [text() for _ in range(1500)], [text() for _ in range(50)]
    counts = np.bincount(np.concatenate(learnt), minlength=gated_lm.SYMBOLS).astype(float)
    first = gated_lm.first_net(counts)
    trainer = gated_lm.Trainer(first.flat, gated_lm.RATE)
    for _ in range(3):
        trainer.learn(np.concatenate(learnt))
    before, after = (gated_lm.log_chances(m, held).sum() for m in (first, trainer.model))
    assert after > 0.8 * before  # both negative: a fifth of the bits at least


def test_held_out_documents_of_the_query(spark):
    rows = catalog.op13_gated_lm(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    check_base(rows, [tuple(r) for r in docs])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_a_step_keeps_arrays_of_their_own():
    """Columns of a wider array make every later operation on them several times slower."""
    model = gated_lm.first_net(np.ones(gated_lm.SYMBOLS))
    state = np.zeros((8, gated_lm.STATE), np.float32)
    kept = gated_lm._step(model, state, np.arange(8))[:5]
    assert all(part.flags.c_contiguous for part in kept)
