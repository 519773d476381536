"""Scores of texts under a gated recurrent language model, learnt from the corpus itself.

A text's tokens are its words, ``A-Z`` lower-cased, and one end.  Counts of all words of all training
documents are summed by shuffle and stay sharded.  The ``HEAD`` most frequent words are symbols of
their own; every other word is a symbol of one of ``TAILS`` classes by its last bytes, and within its
class has a chance by its count with absolute discounting, where all unseen words of a class are one
outcome, as they are in the base score.

The network is a gated recurrent unit over these symbols with a class-factored softmax: a class of
head words, the end, or a tail class first, then a word of the class.  Its output biases start at the
symbols' frequencies.  It learns by truncated backpropagation in numpy: ``ROUNDS`` passes over a share
of the training documents each run every training document once, and the loss of every ``WINDOW``
steps is propagated back through these; each token is in one window.  All tasks of a round start
from the same parameters and train on their own documents; then the parameters are averaged by
tokens.  A text's score is the sum over all its tokens; the state goes on from window to window,
from the text's start to its end.

Words are numbered within slices of ``SLICE_BYTES`` of text as they are read, so only a slice's
distinct words meet the counts, and texts move as numbers.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.arrow import map_batches
from sluicework.sources.storage import Staging

# Fixed values of the contract: the fold that is never learnt from, the base score's smoothing.
FOLDS, HELD_OUT = 10, 0
SMOOTHING = 0.1

SLICE_BYTES = 16 << 20
# Symbols: the end, head words (in classes of CLASS_WORDS), tail classes.
HEAD, CLASS_WORDS, TAILS = 512, 32, 31
HEAD_CLASSES = HEAD // CLASS_WORDS
SYMBOLS = 1 + HEAD + TAILS
CLASSES = 1 + HEAD_CLASSES + TAILS
END = 0
# Longer words are never head words, which bounds the table of those.
HEAD_BYTES = 64
TAIL_BYTES = 3

STATE = 16
ROUNDS = 4
RATE = 0.03
# The loss of every WINDOW steps is propagated back through these.
WINDOW, LANES = 16, 256
LEARN_TOKENS = 1 << 20
SCORE_WINDOW, SCORE_LANES = 16, 256
SCORE_TOKENS = 4 << 20
# A task trains on so many tokens at least, where its round has them.
SHARD_TOKENS = 4 << 20
CLIP = 1.0

SHAPES = {
    "inputs": (SYMBOLS, 3 * STATE),
    "states": (STATE, 3 * STATE),
    "classes": (STATE, CLASSES),
    "class_bias": (CLASSES,),
    "words": (HEAD_CLASSES, STATE, CLASS_WORDS),
    "word_bias": (HEAD_CLASSES, CLASS_WORDS),
}
SIZES = [int(np.prod(shape)) for shape in SHAPES.values()]


class Net(NamedTuple):
    """The parameters, as views of one flat array."""

    flat: np.ndarray
    inputs: np.ndarray
    states: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray


def net(flat: np.ndarray) -> Net:
    parts = np.split(flat, np.cumsum(SIZES)[:-1])
    return Net(flat, *(p.reshape(shape) for p, shape in zip(parts, SHAPES.values(), strict=True)))


def first_net(symbol_counts: np.ndarray) -> Net:
    """Small fixed random weights, and biases of the symbols' frequencies."""
    rng = np.random.default_rng(13)
    made = net(np.zeros(sum(SIZES), np.float32))
    for part in (made.inputs, made.states, made.classes, made.words):
        part[:] = rng.normal(0, 0.08, part.shape)
    counts = symbol_counts + 0.5
    words = counts[1 : 1 + HEAD].reshape(HEAD_CLASSES, CLASS_WORDS)
    classes = np.concatenate([counts[:1], words.sum(1), counts[1 + HEAD :]])
    made.class_bias[:] = np.log(classes / classes.sum())
    made.word_bias[:] = np.log(words / words.sum(1, keepdims=True))
    return made


def class_of(symbols: np.ndarray) -> np.ndarray:
    head = (symbols - 1) // CLASS_WORDS + 1
    tail = symbols - HEAD + HEAD_CLASSES
    return np.where(symbols == END, 0, np.where(symbols <= HEAD, head, tail))


def _step(model: Net, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state (zero behind an end) and what its gradient needs."""
    own = model.inputs.take(symbols, 0)
    through = state @ model.states
    gates = own[:, : 2 * STATE] + through[:, : 2 * STATE]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    # Arrays of their own, as operations on columns of a wider one take three times as long.
    update, reset = gates[:, :STATE].copy(), gates[:, STATE:].copy()
    memory = through[:, 2 * STATE :].copy()
    fresh = reset * memory
    fresh += own[:, 2 * STATE :]
    np.tanh(fresh, out=fresh)
    after = state - fresh
    after *= update
    after += fresh
    ends = np.flatnonzero(symbols == END)
    after[ends] = 0
    return after, update, reset, memory, fresh, ends


def _softmax(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray):
    """Exponentials of the logits, the wanted ones' log chances, and the sums."""
    logits = states @ weights
    logits += bias
    size = logits.shape[1]
    # States are between -1 and 1; where that bounds the logits, no row needs its maximum first.
    if np.abs(bias).max() + np.abs(weights).sum(0).max() > 60:
        logits -= logits.max(1, keepdims=True)
    chosen = logits.ravel().take(np.arange(0, logits.size, size) + wanted)
    np.exp(logits, out=logits)
    total = logits @ np.ones(size, logits.dtype)
    return logits, chosen - np.log(total), total


def _output(model: Net, states: np.ndarray, symbols: np.ndarray, gradient: Net | None = None):
    """Natural log chances of ``symbols`` behind ``states``; with ``gradient`` also the loss's
    gradient by the states, adding the parameters' own to it."""
    of = class_of(symbols)
    logits, logp, total = _softmax(states, model.classes, model.class_bias, of)
    back = None
    if gradient is not None:
        logits /= total[:, None]
        logits.ravel()[np.arange(0, logits.size, CLASSES) + of] -= 1
        back = logits @ model.classes.T
        gradient.classes[:] += states.T @ logits
        gradient.class_bias[:] += logits.sum(0)
    heads = np.flatnonzero((symbols >= 1) & (symbols <= HEAD))
    # Sorted by radix, as short integers are.
    heads = heads[np.argsort(of[heads].astype(np.uint8), kind="stable")]
    edges = np.searchsorted(of[heads], np.arange(1, HEAD_CLASSES + 2))
    for k in range(HEAD_CLASSES):
        at = heads[edges[k] : edges[k + 1]]
        if not len(at):
            continue
        own = states.take(at, 0)
        word = (symbols[at] - 1) % CLASS_WORDS
        inner, more, total = _softmax(own, model.words[k], model.word_bias[k], word)
        logp[at] += more
        if gradient is not None:
            inner /= total[:, None]
            inner.ravel()[np.arange(0, inner.size, CLASS_WORDS) + word] -= 1
            back[at] = back.take(at, 0) + inner @ model.words[k].T
            gradient.words[k] += own.T @ inner
            gradient.word_bias[k] += inner.sum(0)
    return logp, back


def window_gradient(model: Net, state: np.ndarray, window: np.ndarray, gradient: Net):
    """Sum of the log chances of a window (steps by lanes), the state behind it; adds the gradient of
    the loss, propagated back to the window's begin, to ``gradient``."""
    steps, lanes = window.shape
    states, kept = [], []
    for symbols in window:
        states.append(state)
        state, *rest = _step(model, state, symbols)
        kept.append(rest)
    before = np.concatenate(states)
    logp, back = _output(model, before, window.ravel(), gradient)
    back = back.reshape(steps, lanes, STATE)
    inputs = np.empty((steps, lanes, 3 * STATE), np.float32)
    throughs = np.empty_like(inputs)
    later = np.zeros_like(state)
    for t in range(steps - 1, -1, -1):
        update, reset, memory, fresh, ends = kept[t]
        later[ends] = 0
        stays = 1 - update
        by_fresh = later * stays * (1 - fresh * fresh)
        by_update = later * (states[t] - fresh) * update * stays
        by_reset = by_fresh * memory * reset * (1 - reset)
        np.concatenate([by_update, by_reset, by_fresh], 1, out=inputs[t])
        through = throughs[t]
        np.concatenate([by_update, by_reset, by_fresh * reset], 1, out=through)
        later = later * update + through @ model.states.T + back[t]
    gradient.states[:] += before.T @ throughs.reshape(-1, 3 * STATE)
    flat = window.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
    rows = inputs.reshape(-1, 3 * STATE).take(order, 0)
    gradient.inputs[flat[order][begins]] += np.add.reduceat(rows, begins)
    return logp.sum(dtype=float), state


class Trainer:
    """Adam over windows of ``LANES`` streams that go on through the documents in order."""

    def __init__(self, start: np.ndarray, rate: float) -> None:
        self.model = net(start.copy())
        self._gradient = net(np.zeros_like(start))
        self._mean = np.zeros_like(start)
        self._square = np.zeros_like(start)
        self._rate, self._steps = rate, 0

    def learn(self, symbols: np.ndarray) -> None:
        """One pass over documents that stand one after the other, each with its end."""
        lanes = max(1, min(LANES, len(symbols) // WINDOW))
        length = -(-len(symbols) // lanes)
        # The last stream is filled up with ends, whose state is zero.
        streams = np.full(lanes * length, END, np.int64)
        streams[: len(symbols)] = symbols
        streams = np.ascontiguousarray(streams.reshape(lanes, length).T)
        state = np.zeros((lanes, STATE), np.float32)
        for begin in range(0, length, WINDOW):
            window = streams[begin : begin + WINDOW]
            self._gradient.flat[:] = 0
            _, state = window_gradient(self.model, state, window, self._gradient)
            self._gradient.flat[:] /= window.size
            self._update()

    def _update(self) -> None:
        g = self._gradient.flat
        norm = float(np.sqrt(np.square(g).sum(dtype=float)))
        if norm > CLIP:
            g *= CLIP / norm
        self._steps += 1
        self._mean += 0.1 * (g - self._mean)
        self._square += 0.01 * (g * g - self._square)
        scale = self._rate * np.sqrt(1 - 0.99**self._steps) / (1 - 0.9**self._steps)
        self.model.flat[:] -= scale * self._mean / (np.sqrt(self._square) + 1e-8)


def log_chances(model: Net, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log chance of each whole text of symbols (with its end).

    Texts are dealt to lanes, longest first; a lane's state is zero behind each end, so it carries
    through all windows of a text and into no other.
    """
    lanes: list[list[int]] = [[] for _ in range(min(SCORE_LANES, max(len(texts), 1)))]
    load = [(0, k) for k in range(len(lanes))]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        size, k = load[0]
        lanes[k].append(i)
        heapq.heapreplace(load, (size + len(texts[i]), k))
    lanes.sort(key=lambda own: -sum(len(texts[i]) for i in own))
    order = [i for own in lanes for i in own]
    if not order:
        return np.zeros(0)
    flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
    lengths = np.array([sum(len(texts[i]) for i in own) for own in lanes])
    offsets = np.cumsum(lengths) - lengths
    logp = np.zeros(len(flat))
    state = np.zeros((len(lanes), STATE), np.float32)
    for begin in range(0, int(lengths[0]), SCORE_WINDOW):
        states, places = [], []
        for t in range(begin, min(begin + SCORE_WINDOW, int(lengths[0]))):
            active = int(np.searchsorted(-lengths, -t))
            places.append(offsets[:active] + t)
            state = state[:active]
            states.append(state)
            state = _step(model, state, flat[places[-1]])[0]
        at = np.concatenate(places)
        logp[at] = _output(model, np.concatenate(states), flat[at])[0]
    sizes = np.array([len(texts[i]) for i in order])
    out = np.empty(len(texts))
    out[order] = np.add.reduceat(logp, np.cumsum(sizes) - sizes)
    return out


# Corpus side: numbers, counts, symbols


def _numbered(docs: DataFrame) -> DataFrame:
    """Slices of documents as numbers, and each slice's words with their count in training texts.

    Rows of both kinds: a document has ``tokens`` (32-bit numbers), a word has ``word, number, n``.
    """
    schema = (
        "slice bigint, doc_id bigint, held_out boolean, learnt boolean, round int, tokens binary,"
        " word binary, number int, n bigint"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, done = TaskContext.get().partitionId() << 32, 0
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        learnt_tokens: list[np.ndarray] = []
        size = 0

        def words() -> dict:
            n = len(numbers)
            times = np.zeros(n, np.int64)
            if learnt_tokens:
                times += np.bincount(np.concatenate(learnt_tokens), minlength=n)
            none = pa.nulls(n)
            return dict.fromkeys(("doc_id", "held_out", "learnt", "round", "tokens"), none) | {
                "slice": np.full(n, part + done),
                "word": list(numbers),
                "number": np.arange(n),
                "n": times,
            }

        for batch in batches:
            rows = batch.to_pydict()
            begin = 0
            coded: list[bytes] = []
            for i, (text, learnt) in enumerate(zip(rows["text"], rows["learnt"], strict=True)):
                raw = (text or "").encode()
                if size and size + len(raw) > SLICE_BYTES:
                    if coded:
                        yield _documents(batch, begin, coded, part + done)
                    yield words()
                    begin, coded, size, done = i, [], 0, done + 1
                    learnt_tokens.clear()
                    numbers.clear()
                    numbers.default_factory = count().__next__
                own = raw.lower().split()
                tokens = np.fromiter(map(numbers.__getitem__, own), np.int32, len(own))
                if learnt:
                    learnt_tokens.append(tokens)
                coded.append(tokens.tobytes())
                size += len(raw) + 1
            if coded:
                yield _documents(batch, begin, coded, part + done)
        if size:
            yield words()

    def _documents(batch: pa.RecordBatch, begin: int, coded: list[bytes], number: int) -> dict:
        n = len(coded)
        own = batch.slice(begin, n)
        kept = {c: own.column(c) for c in ("doc_id", "held_out", "learnt", "round")}
        none = dict.fromkeys(("word", "number", "n"), pa.nulls(n))
        return kept | none | {"slice": np.full(n, number), "tokens": coded}

    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    asked = docs.select(
        "doc_id",
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(fold != HELD_OUT, F.lit(False)).alias("learnt"),
        F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)).cast("int").alias("round"),
        "text",
    )
    return map_batches(asked, schema, work)


def _counted(words: DataFrame) -> DataFrame:
    """Every slice's words with their count ``c`` in all training texts and their tail class;
    ``first`` marks one row of each distinct word.  A word's rows are as many as slices have it."""
    of_word = Window.partitionBy("word")
    last = F.substring("word", -TAIL_BYTES, TAIL_BYTES)
    return words.select(
        "slice",
        "number",
        "word",
        F.sum("n").over(of_word).alias("c"),
        (F.min("slice").over(of_word) == F.col("slice")).alias("first"),
        (F.crc32(last) % TAILS).cast("int").alias("tail"),
    )


class Corpus(NamedTuple):
    """What is known of all training tokens: their number, distinct ones, and the symbols'."""

    tokens: int
    distinct: int
    documents: int
    symbol_counts: np.ndarray
    # By tail class: tokens, distinct words and the discount of each count.
    tail_tokens: np.ndarray
    tail_distinct: np.ndarray
    discounts: np.ndarray


def _summed(counted: DataFrame, head: list, documents: int) -> Corpus:
    once = counted.filter("first AND c > 0").groupBy("tail")
    rows = once.agg(
        F.sum("c").alias("c"),
        F.count("*").alias("v"),
        F.count_if(F.col("c") == 1).alias("n1"),
        F.count_if(F.col("c") == 2).alias("n2"),
    ).collect()  # a row per tail class
    by_tail = np.zeros((4, TAILS))
    for row in rows:
        by_tail[:, row["tail"]] = row["c"], row["v"], row["n1"], row["n2"]
    tokens, distinct = int(by_tail[0].sum()), int(by_tail[1].sum())
    symbols = np.zeros(SYMBOLS)
    symbols[END] = documents
    for i, row in enumerate(head):
        symbols[1 + i] = row["c"]
        by_tail[:, row["tail"]] -= row["c"], 1, row["c"] == 1, row["c"] == 2
    symbols[1 + HEAD :] = by_tail[0]
    _, _, n1, n2 = by_tail
    discounts = np.where(n1 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5).clip(0.05, 0.95)
    return Corpus(
        tokens + documents,
        distinct + (documents > 0),
        documents,
        symbols,
        by_tail[0],
        by_tail[1],
        discounts,
    )


CODED = (
    "doc_id bigint, held_out boolean, learnt boolean, round int, n_tokens bigint, n_known bigint,"
    " base_score double, tail_score double, symbols binary"
)


def _coded(documents: DataFrame, hits: DataFrame, known: Corpus) -> DataFrame:
    """Each document as symbols, with its base score and the score of its tail words in their
    classes; both need its words' counts, which come back to the slice by number."""
    whole = known.tokens + SMOOTHING * (known.distinct + 1)

    def work(own: pa.Table, found: pa.Table) -> pa.Table:
        size = found.num_rows
        counts, symbols = np.zeros(size), np.zeros(size, np.int64)
        number = found["number"].to_numpy()
        counts[number] = found["c"].to_numpy()
        symbols[number] = found["symbol"].to_numpy()
        base = np.log10((counts + SMOOTHING) / whole)
        tail = np.maximum(symbols - 1 - HEAD, 0)
        total = np.maximum(known.tail_tokens, 1)[tail]
        less = known.discounts[tail]
        unseen = np.where(known.tail_tokens > 0, known.discounts * known.tail_distinct, 1)[tail]
        inner = np.where(counts > 0, np.maximum(counts - less, 1e-9), unseen) / total
        inner = np.where(symbols > HEAD, np.log10(inner), 0)
        end = np.log10((known.documents + SMOOTHING) / whole)
        out = {name: own[name] for name in ("doc_id", "held_out", "learnt", "round")}
        more: dict[str, list] = {
            "n_tokens": [], "n_known": [], "base_score": [], "tail_score": [], "symbols": []
        }
        for raw in own["tokens"].to_pylist():
            tokens = np.frombuffer(raw, np.int32)
            more["n_tokens"].append(len(tokens) + 1)
            more["n_known"].append(
                int(np.count_nonzero(counts[tokens])) + (known.documents > 0)
            )
            more["base_score"].append(float(base[tokens].sum() + end))
            more["tail_score"].append(float(inner[tokens].sum()))
            more["symbols"].append(np.append(symbols[tokens], END).astype(np.uint16).tobytes())
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "symbols": pa.binary()}
        arrays = {k: pa.array(v, kinds.get(k, pa.float64())) for k, v in more.items()}
        return pa.table(out | arrays)

    return (
        documents.groupBy("slice").cogroup(hits.groupBy("slice")).applyInArrow(work, CODED)
    )


def _round(coded: DataFrame, number: int, start: np.ndarray, tokens: int) -> np.ndarray:
    """The parameters after one round, averaged over its tasks by their tokens."""
    sent = coded.sparkSession.sparkContext.broadcast(start)
    rate = RATE / 2**number

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trainer, seen, held, size = Trainer(sent.value, rate), 0, [], 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                held.append(np.frombuffer(raw, np.uint16))
                size += len(held[-1])
                if size >= LEARN_TOKENS:
                    trainer.learn(np.concatenate(held))
                    seen, held, size = seen + size, [], 0
        if held:
            trainer.learn(np.concatenate(held))
            seen += size
        if seen:
            values = trainer.model.flat.astype(float)
            yield {
                "place": np.arange(len(values)),
                "value": values * seen,
                "weight": np.full(len(values), float(seen)),
            }

    own = coded.filter(F.col("learnt") & (F.col("round") == number)).select("symbols")
    found = (
        map_batches(
            own.coalesce(max(1, -(-tokens // SHARD_TOKENS))),
            "place int, value double, weight double",
            work,
        )
        .groupBy("place")
        .agg((F.sum("value") / F.sum("weight")).alias("value"))
        .orderBy("place")
        .toArrow()  # as many rows as there are parameters
    )
    return found["value"].to_numpy().astype(np.float32) if found.num_rows else start


def train(coded: DataFrame, known: Corpus) -> np.ndarray:
    """The network's parameters after all rounds."""
    flat = first_net(known.symbol_counts).flat
    if known.documents:
        for number in range(ROUNDS):
            flat = _round(coded, number, flat, -(-known.tokens // ROUNDS))
    return flat


def _head(counted: DataFrame) -> list:
    """The most frequent words; of equally frequent ones the first in byte order."""
    short = counted.filter(f"first AND c > 0 AND length(word) <= {HEAD_BYTES}")
    return short.select("word", "c", "tail").orderBy(F.desc("c"), "word").limit(HEAD).collect()


def _symbols(spark: SparkSession, counted: DataFrame, head: list) -> DataFrame:
    """``slice, number, c, symbol`` of every slice's words."""
    rows = [(bytearray(row["word"]), 1 + i) for i, row in enumerate(head)]
    # HEAD rows of HEAD_BYTES at most.
    table = F.broadcast(spark.createDataFrame(rows, "word binary, own int"))
    symbol = F.coalesce("own", F.col("tail") + 1 + HEAD).alias("symbol")
    return counted.join(table, "word", "left").select("slice", "number", "c", symbol)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each whole text.

    Scores are log10 chances.  A null or empty text is the end alone.  A row without id is neither
    held out nor learnt from; repeated rows are learnt from and answered each; other columns are
    ignored.  Without training documents every token is unseen.  A task holds a slice, or one longer
    text, as numbers.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    numbered = staging.table(_numbered(docs.select("doc_id", "text")))
    documents = numbered.filter("tokens IS NOT NULL").drop("word", "number", "n")
    words = numbered.filter("word IS NOT NULL").select("slice", "word", "number", "n")
    counted = staging.table(_counted(words))
    head = _head(counted)
    known = _summed(counted, head, documents.filter("learnt").count())
    hits = _symbols(spark, counted, head)
    coded = staging.table(_coded(documents, hits, known))
    sent = spark.sparkContext.broadcast(train(coded, known))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = net(sent.value)
        names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score")

        def scored(rows: pa.Table) -> dict:
            texts = [np.frombuffer(raw, np.uint16) for raw in rows["symbols"].to_pylist()]
            total = log_chances(model, texts) / np.log(10) + rows["tail_score"].to_numpy()
            told = {name: rows[name] for name in names}
            told["train_tokens"] = np.full(rows.num_rows, known.tokens)
            return {k: pa.chunked_array(v).combine_chunks() if isinstance(v, list) else
                    v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
                    for k, v in told.items()} | {"score": total}

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            ends = np.cumsum(batch.column("n_tokens").to_numpy())
            begin = 0
            while begin < batch.num_rows:
                before = ends[begin - 1] if begin else 0
                end = max(int(np.searchsorted(ends, before + SCORE_TOKENS - size)), begin + 1)
                held.append(batch.slice(begin, end - begin))
                size += int(ends[min(end, batch.num_rows) - 1] - before)
                begin = end
                if size >= SCORE_TOKENS:
                    yield scored(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield scored(pa.Table.from_batches(held))

    return map_batches(
        coded,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double",
        work,
    )
