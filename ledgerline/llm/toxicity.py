"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each word enters as a word vector (words of the training vocabulary) and the mean of its
character n-gram vectors (hashed, so unseen words and spellings carry meaning). A token of
more than ``LONGEST`` characters (scripts without spaces, joined words) is read as several
words, its overlapping parts. A GRU reads a window of words in both directions, attention weighs its states, and a linear layer
gives the window's logit. All overlapping windows of the whole text are scored (half
a window apart, the last one at the text's end); the largest logit, with the number of
windows, gives the document's score by a logistic curve. The curve is fitted on the same two numbers, taken over all
windows of the training documents' whole texts.

Training is numpy on the driver, on a bounded sample: of the ``toxic_docs`` and ``clean_docs``
labelled documents whose hash is smallest, those of up to ``sample_chars`` characters, each with all windows of its whole
text. Every window of a clean document is an example of label 0; of a toxic document
the window that the model finds most toxic is one of label 1 (in the first pass, all are).

Scale: the sample's ids are broadcast (their number is a parameter), so texts aren't
shuffled, and scoring is a map over batches. A word's input projections are computed once
per task and remembered (bounded; forgotten words are computed again).

Defined results: a null text or one without words scores 0; a document with several labels
counts as toxic if any says so; without labels of both kinds every text scores the only
label (0 without any); repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.hyperlang import in_training

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIMS, CHAR_DIMS, ATTENTION = 8, 8, 8, 8
GRAMS = 1 << 13
LEAST_DOCS = 4  # training documents that a word must be in to have a vector
TOXIC_DOCS, CLEAN_DOCS, SAMPLE_CHARS = 600, 900, 100_000
PASSES, BATCH_DOCS, RATE = 4, 40, 0.01
LONGEST, OVERLAP = 64, 16  # characters of a word, and shared by the parts of a longer one
KNOWN_WORDS = 200_000  # words whose projections a task remembers
SCORED_TOGETHER = 1024  # windows
_STRIP = ".,;:!?\"'()[]{}<>«»“”…"

Model = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    words = [w.strip(_STRIP) or w for w in text.lower().split()]
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [part for w in words for part in word_parts(w)]


def word_parts(word: str) -> list[str]:
    """Overlapping parts of a long word; the last part ends with the word."""
    starts = [*range(0, len(word) - LONGEST, LONGEST - OVERLAP), max(0, len(word) - LONGEST)]
    return [word[s : s + LONGEST] for s in starts]


def grams_of(word: str) -> list[int]:
    """Hashed character 3- and 4-grams, with the word's ends marked."""
    marked = f"^{word}$"
    return [zlib.crc32(marked[i : i + n].encode()) % GRAMS for n in (3, 4) for i in range(max(1, len(marked) - n + 1))]


def window_starts(n: int) -> list[int]:
    """Starts of all windows over n words; the last window ends with the text."""
    if n <= WINDOW:
        return [0] if n else []
    starts = list(range(0, n - WINDOW, STRIDE))
    return [*starts, n - WINDOW]


def new_model(rng: np.random.Generator, vocabulary: int) -> Model:
    d = WORD_DIMS + CHAR_DIMS
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "word": np.zeros((vocabulary + 1, WORD_DIMS), np.float32),  # row 0: any other word
        "gram": normal(GRAMS, CHAR_DIMS, scale=0.3),
        "in": normal(2, d, 3 * HIDDEN, scale=d**-0.5),
        "in_bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "state": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "state_bias": np.zeros((2, 1, HIDDEN), np.float32),
        "attend": normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5),
        "attend_bias": np.zeros(ATTENTION, np.float32),
        "attend_out": normal(ATTENTION, scale=ATTENTION**-0.5),
        "out": normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def word_inputs(model: Model, ids: np.ndarray, grams: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs of each word, all grams, the word of each gram)."""
    flat = np.array([g for gs in grams for g in gs], np.int64)
    of = np.repeat(np.arange(len(grams)), [len(gs) for gs in grams])
    starts = np.concatenate([[0], np.cumsum([len(gs) for gs in grams])[:-1]]).astype(np.int64)
    mean = np.add.reduceat(model["gram"][flat], starts) / np.array([[len(gs)] for gs in grams], np.float32)
    return np.concatenate([model["word"][ids], mean], 1).astype(np.float32), flat, of


def project(model: Model, inputs: np.ndarray) -> np.ndarray:
    """(2, words, 3 * HIDDEN): what each word adds to the gates, by direction."""
    return inputs @ model["in"] + model["in_bias"]


def forward(model: Model, gates: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: bool = False):
    """Logits of windows ``index`` (windows x WINDOW word numbers). mask: 1 for words, 0
    for padding, None without padding. keep: also what backward() needs."""
    n, steps = index.shape
    h = np.zeros((2, n, HIDDEN), gates.dtype)
    states = np.empty((n, steps, 2 * HIDDEN), gates.dtype)
    tape = []
    for t in range(steps):
        u = steps - 1 - t
        p = np.empty((2, n, 3 * HIDDEN), gates.dtype)
        np.take(gates[0], index[:, t], axis=0, out=p[0])
        np.take(gates[1], index[:, u], axis=0, out=p[1])
        a = np.matmul(h, model["state"])
        zr = sigmoid(p[..., : 2 * HIDDEN] + a[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        q = a[..., 2 * HIDDEN :] + model["state_bias"]
        c = np.tanh(p[..., 2 * HIDDEN :] + r * q)
        new = c + z * (h - c)
        m = None
        if mask is not None:
            m = np.stack([mask[:, t], mask[:, u]])[..., None]
            new = h + m * (new - h)
        if keep:
            tape.append((h, z, r, q, c, m))
        h = new
        states[:, t, :HIDDEN], states[:, u, HIDDEN:] = h[0], h[1]
    act = np.tanh(states @ model["attend"] + model["attend_bias"])
    e = act @ model["attend_out"]
    if mask is not None:
        e = np.where(mask > 0, e, np.float32(-1e9))
    w = np.exp(e - e.max(1, keepdims=True))
    w /= w.sum(1, keepdims=True)
    pooled = np.matmul(w[:, None, :], states)[:, 0]
    logits = pooled @ model["out"] + model["out_bias"][0]
    return (logits, (tape, states, act, w, pooled)) if keep else logits


def backward(model: Model, gates: np.ndarray, index: np.ndarray, mask: np.ndarray | None, kept, d_logits: np.ndarray) -> tuple[Model, np.ndarray]:
    """(gradients of the model's matrices, gradient of ``gates``)."""
    tape, states, act, w, pooled = kept
    n, steps = index.shape
    g = {k: np.zeros_like(v) for k, v in model.items() if k not in ("word", "gram")}
    g["out"], g["out_bias"] = pooled.T @ d_logits, np.array([d_logits.sum()], gates.dtype)
    d_pooled = d_logits[:, None] * model["out"]
    d_states = w[..., None] * d_pooled[:, None, :]
    d_w = np.matmul(states, d_pooled[..., None])[..., 0]
    d_e = w * (d_w - (w * d_w).sum(1, keepdims=True))
    g["attend_out"] = np.tensordot(act, d_e, ([0, 1], [0, 1]))
    d_act = d_e[..., None] * model["attend_out"] * (1 - act * act)
    g["attend"], g["attend_bias"] = np.tensordot(states, d_act, ([0, 1], [0, 1])), d_act.sum((0, 1))
    d_states += d_act @ model["attend"].T
    d_gates = np.zeros_like(gates)
    d_h = np.zeros((2, n, HIDDEN), gates.dtype)
    for t in range(steps - 1, -1, -1):
        u = steps - 1 - t
        h, z, r, q, c, m = tape[t]
        d_h[0] += d_states[:, t, :HIDDEN]
        d_h[1] += d_states[:, u, HIDDEN:]
        d_new = d_h if m is None else d_h * m
        d_prev = 0 if m is None else d_h * (1 - m)
        d_c = d_new * (1 - z) * (1 - c * c)
        d_z = d_new * (h - c) * z * (1 - z)
        d_r = d_c * q * r * (1 - r)
        d_q = d_c * r
        d_a = np.concatenate([d_z, d_r, d_q], 2)
        d_p = np.concatenate([d_z, d_r, d_c], 2)
        g["state"] += np.matmul(h.transpose(0, 2, 1), d_a)
        g["state_bias"] += d_q.sum(1, keepdims=True)
        np.add.at(d_gates[0], index[:, t], d_p[0])
        np.add.at(d_gates[1], index[:, u], d_p[1])
        d_h = d_prev + d_new * z + np.matmul(d_a, model["state"].transpose(0, 2, 1))
    return g, d_gates


class Adam:
    def __init__(self, model: Model, rate: float):
        self.rate, self.step = rate, 0
        self.mean, self.square = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))

    def update(self, model: Model, grads: Model) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            model[k] -= (scale * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(np.float32)


class Vocabulary:
    """Word numbers of a set of words: their vector's row and their grams."""

    def __init__(self, rows: dict[str, int]):
        self.rows, self.number, self.ids, self.grams = rows, {}, [0], [[0]]  # number 0 pads

    def add(self, word: str) -> int:
        n = self.number.get(word)
        if n is None:
            n = self.number[word] = len(self.ids)
            self.ids.append(self.rows.get(word, 0))
            self.grams.append(grams_of(word))
        return n


def padded(windows: list[list[int]]) -> tuple[np.ndarray, np.ndarray | None]:
    index = np.zeros((len(windows), WINDOW), np.int64)
    for row, w in zip(index, windows, strict=True):
        row[: len(w)] = w
    if all(len(w) == WINDOW for w in windows):
        return index, None
    return index, (np.arange(WINDOW) < np.array([[len(w)] for w in windows])).astype(np.float32)


def fit(docs: list[tuple[int, list[list[str]]]], seed: int = 5, passes: int = PASSES, rate: float = RATE) -> tuple[Model, dict[str, int]]:
    """(model, rows of the vocabulary) from (label, windows of words) of each document."""
    rng = np.random.default_rng(seed)
    seen = Counter(w for _, windows in docs for w in {w for window in windows for w in window})
    rows = {w: i + 1 for i, w in enumerate(sorted(w for w, n in seen.items() if n >= LEAST_DOCS))}
    model = new_model(rng, len(rows))
    words = Vocabulary(rows)
    coded = [(label, [[words.add(w) for w in window] for window in windows]) for label, windows in docs if windows]
    ids = np.array(words.ids)
    adam = Adam(model, rate)
    steps = max(1, passes * -(-len(coded) // BATCH_DOCS))
    for epoch in range(passes):
        order = rng.permutation(len(coded))
        for at in range(0, len(order), BATCH_DOCS):
            adam.rate = rate * (1 - 0.9 * adam.step / steps)
            batch = [coded[i] for i in order[at : at + BATCH_DOCS]]
            label = np.array([y for y, windows in batch for _ in windows], np.float32)
            doc = np.repeat(np.arange(len(batch)), [len(w) for _, w in batch])
            index, mask = padded([w for _, windows in batch for w in windows])
            used, index = np.unique(index, return_inverse=True)
            index = index.reshape(-1, WINDOW)
            inputs, flat, of = word_inputs(model, ids[used], [words.grams[i] for i in used])
            gates = project(model, inputs)
            logits, kept = forward(model, gates, index, mask, keep=True)
            weight = np.where(label > 0, 1.0, 1.0 / np.bincount(doc)[doc]) if epoch else 1.0 / np.bincount(doc)[doc]
            if epoch:  # of a toxic document only the window found most toxic
                best = np.full(len(batch), -np.inf)
                np.maximum.at(best, doc, logits)
                weight = np.where((label > 0) & (logits < best[doc]), 0.0, weight)
            d_logits = ((sigmoid(logits) - label) * weight / len(batch)).astype(np.float32)
            grads, d_gates = backward(model, gates, index, mask, kept, d_logits)
            grads["in"], grads["in_bias"] = np.matmul(inputs.T, d_gates), d_gates.sum(1, keepdims=True)
            d_inputs = np.matmul(d_gates, model["in"].transpose(0, 2, 1)).sum(0)
            grads["word"], grads["gram"] = np.zeros_like(model["word"]), np.zeros_like(model["gram"])
            np.add.at(grads["word"], ids[used], d_inputs[:, :WORD_DIMS])
            grads["word"][0] = 0
            share = np.bincount(of, minlength=len(used))[of][:, None]
            np.add.at(grads["gram"], flat, d_inputs[of, WORD_DIMS:] / share)
            adam.update(model, grads)
    return model, rows


def logistic(features: np.ndarray, labels: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights and bias of a logistic regression (Newton steps, lightly ridged)."""
    x = np.concatenate([features, np.ones((len(features), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - labels) + 1e-2 * w)
    return w


class Scorer:
    """Logits of all windows of texts; remembers words' projections."""

    def __init__(self, model: Model, rows: dict[str, int]):
        self.model, self.rows = model, rows
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.gates = np.zeros((2, 1 << 12, 3 * HIDDEN), np.float32)
        self.count = 1

    def _learn(self, words: list[str]) -> None:
        inputs, _, _ = word_inputs(self.model, np.array([self.rows.get(w, 0) for w in words]), [grams_of(w) for w in words])
        while self.count + len(words) > self.gates.shape[1]:
            self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)], 1)
        self.gates[:, self.count : self.count + len(words)] = project(self.model, inputs)
        self.number.update(zip(words, range(self.count, self.count + len(words)), strict=True))
        self.count += len(words)

    def numbers(self, words: list[str]) -> np.ndarray:
        if new := [w for w in dict.fromkeys(words) if w not in self.number]:
            if self.count + len(new) > KNOWN_WORDS and self.count > 1:
                raise LookupError  # numbers in use would change their meaning
            self._learn(new)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _logits(self, index: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), np.float32)
        short = lengths < WINDOW
        for some in (np.flatnonzero(~short), np.flatnonzero(short)):
            for at in range(0, len(some), SCORED_TOGETHER):
                rows = some[at : at + SCORED_TOGETHER]
                mask = (np.arange(WINDOW) < lengths[rows, None]).astype(np.float32) if short[rows[0]] else None
                out[rows] = forward(self.model, self.gates, index[rows], mask)
        return out

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(largest window logit, number of windows) of each text."""
        best, count = np.full(len(texts), -np.inf, np.float32), np.zeros(len(texts), np.int64)
        index, lengths, doc, size = [], [], [], 0

        def score() -> None:
            nonlocal size
            if size:
                np.maximum.at(best, np.concatenate(doc), self._logits(np.concatenate(index), np.concatenate(lengths)))
            index.clear(), lengths.clear(), doc.clear()
            size = 0

        for i, text in enumerate(texts):
            words = words_of(text)
            for part in range(0, len(words), MOST_WORDS):  # a very long text is scored in parts that overlap
                some = words[max(0, part - WINDOW + STRIDE) : part + MOST_WORDS]
                try:
                    numbers = self.numbers(some)
                except LookupError:
                    score()
                    self._forget()
                    self._learn(list(dict.fromkeys(some)))
                    numbers = self.numbers(some)
                starts = np.array(window_starts(len(numbers)), np.int64)
                if len(numbers) < WINDOW:
                    numbers = np.concatenate([numbers, np.zeros(WINDOW - len(numbers), np.int64)])
                index.append(numbers[starts[:, None] + np.arange(WINDOW)])
                lengths.append(np.full(len(starts), min(len(some), WINDOW)))
                doc.append(np.full(len(starts), i))
                count[i] += len(starts)
                size += len(starts)
                if size >= 4 * SCORED_TOGETHER:
                    score()
        score()
        return best, count


MOST_WORDS = 20_000  # words of a text whose windows are held at once (a multiple of STRIDE)


def train(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS, sample_chars: int = SAMPLE_CHARS, seed: int = 5, **options):
    """fit() on a bounded sample of the labelled rows that may be learned from; a
    number (the only label) if they don't hold both labels."""
    known = labels.filter(in_training(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    drawn = [known.filter(F.col("toxic") == y).orderBy("draw", "doc_id").limit(n) for y, n in ((1, toxic_docs), (0, clean_docs))]
    sample = drawn[0].union(drawn[1]).select("doc_id", "toxic")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            windows = []
            for text in b.column(2).to_pylist():
                words = words_of(text or "")
                windows.append([" ".join(words[s : s + WINDOW]) for s in window_starts(len(words))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(windows, pa.list_(pa.string()))], names=["doc_id", "toxic", "windows"])

    # at most toxic_docs + clean_docs ids are broadcast, and as many texts of at most sample_chars characters collected
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    texts = texts.filter(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInArrow(cut, f"doc_id {id_type}, toxic {labels.schema['toxic'].dataType.simpleString()}, windows array<string>").collect()
    rows = sorted((r["doc_id"], int(r["toxic"]), list(r["windows"])) for r in rows)
    found = {y for _, y, _ in rows}
    if len(found) < 2:
        return float(found.pop()) if found else 0.0
    trained = fit([(y, [w.split(" ") for w in windows]) for _, y, windows in rows], seed, **options)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*trained)
        for b in batches:
            best, count = scorer.texts([t or "" for t in b.column(2).to_pylist()])
            best = np.where(count > 0, best, 0.0)  # a text without words has no windows
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int64()), pa.array(best, pa.float64()), pa.array(count, pa.int64())], names=["toxic", "best", "windows"])

    # the curve's statistic is the one that scoring uses: over all windows of the whole texts; three numbers a document come back
    seen = sorted(map(tuple, texts.mapInArrow(whole, "toxic long, best double, windows long").collect()))
    label, best, n = (np.array(c, np.float64) for c in zip(*seen, strict=True))
    return *trained, logistic(np.stack([best, np.log1p(n)], 1), label)


def score_toxicity(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of each row of ``docs`` (doc_id, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if isinstance(model, float) else Scorer(model[0], model[1])
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                scores = np.full(part.num_rows, model if scorer is None else 0.0)
                if scorer is not None:
                    best, count = scorer.texts([t or "" for t in part.column(1).to_pylist()])
                    some = count > 0
                    x = np.stack([best[some], np.log1p(count[some]), np.ones(int(some.sum()))], 1).astype(np.float64)
                    scores[some] = 1 / (1 + np.exp(-np.clip(x @ model[2], -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {id_type}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
