"""Quality classifier: random-indexing word vectors, pooled per document, then a two-layer network with calibrated output.

Every word has an index vector, sparse and ternary, drawn from a hash of the word. A word's vector is its own index
vector beside the normalised sum of the index vectors seen around it. A document is the mean of its words' vectors;
the network is numpy, and its temperature is set on training rows kept out of its fit.

Fitted on at most ``SAMPLE_ROWS`` labelled training documents. Random indexing is a sum, so words are counted, contexts
summed and documents pooled on the executors; the driver gets numbers only and fits the network on them. The vocabulary
is every word that occurs ``MIN_COUNT`` times in the sample; others are represented by their shape. Scoring reads every
whole text. Defined results: a null text counts as empty; an empty text gets the network's answer to a zero vector;
with no labelled row, or one label only, every score is that label's share (0.5 without rows).
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.shared import fold, labelled_sample, slices
from tidewire.sources.shared_folder import discard, written

SAMPLE_ROWS, DIMS, NONZERO, REACH, MIN_COUNT, HIDDEN, SAMPLE_PARTS = 8_000, 64, 4, 2, 5, 32, 32
#: Runs of letters, of digits, of marks; line ends.
WORD = re.compile(r"[^\W\d_]+|\d+|\n+|[^\w\s]+|_+")
#: Stand for the words outside the vocabulary.
SHAPES = ("<lower>", "<upper>", "<title>", "<digits>", "<lines>", "<marks>", "<mixed>")
#: Stands, once more, for every word that repeats the word before it.
AGAIN = "<again>"


def shape(word: str) -> str:
    if word[0] == "\n":
        return "<lines>"
    if word.isdigit():
        return "<digits>"
    if not word[0].isalpha():
        return "<marks>"
    return "<lower>" if word.islower() else "<upper>" if word.isupper() and len(word) > 1 else "<title>" if word.istitle() else "<mixed>"


class Vocabulary(dict):
    """Word to number; a word outside it has its shape's number and is not stored."""

    def __missing__(self, word: str) -> int:
        return self[shape(word)]

    def numbers(self, text: str) -> np.ndarray:
        words = WORD.findall(text)
        letters = list(filter(str.isalpha, words))
        again = sum(map(operator.eq, letters, letters[1:]))
        return np.r_[np.fromiter(map(self.__getitem__, words), np.int32), np.full(again, self[AGAIN], np.int32)]


def index_vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of each word's index vector, drawn from hashes of the word."""
    seeds = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    at, sign = np.zeros((len(words), NONZERO), np.int64), np.zeros((len(words), NONZERO), np.float32)
    for j in range(NONZERO):
        drawn = (seeds + np.uint64(1 + j)) * np.uint64(0x9E3779B97F4A7C15)
        drawn = (drawn ^ (drawn >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        drawn ^= drawn >> np.uint64(32)
        place = (drawn % np.uint64(DIMS - j)).astype(np.int64)
        # The j-th free place, past those taken.
        for taken in np.sort(at[:, :j], axis=1).T:
            place += place >= taken
        at[:, j], sign[:, j] = place, np.where(drawn >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    return at, sign


def context_sums(docs: list[np.ndarray], at: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """For every word the sum of the index vectors within ``REACH`` words, over ``docs``; sums of parts of the documents add up."""
    around = np.zeros(len(at) * DIMS)
    ids = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    whose = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for gap in range(1, REACH + 1):
        same = whose[gap:] == whose[:-gap]
        later, earlier = ids[gap:][same], ids[:-gap][same]
        for centre, other in ((later, earlier), (earlier, later)):
            around += np.bincount((centre[:, None] * DIMS + at[other]).ravel(), sign[other].ravel(), len(around))
    return around.reshape(len(at), DIMS)


def word_vectors(at: np.ndarray, sign: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Own index vector beside the unit sum of those around, for every word."""
    own = np.zeros((len(at), DIMS), np.float32)
    np.put_along_axis(own, at, sign, 1)
    return np.hstack([own / np.float32(np.sqrt(NONZERO)), (around / (np.linalg.norm(around, axis=1, keepdims=True) + 1e-9)).astype(np.float32)])


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean of the vectors of a document's words; zero without words. Long documents are counted by word first."""
    if not len(ids):
        return np.zeros(vectors.shape[1], np.float32)
    if len(ids) > len(vectors):
        return np.bincount(ids, minlength=len(vectors)).astype(np.float32) @ vectors / len(ids)
    return vectors[ids].mean(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    vocabulary: Vocabulary
    projected: np.ndarray  # word vectors times the first layer: pooling is linear, so it may follow
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        x = np.array([pooled(self.vocabulary.numbers(t), self.projected) for t in texts], np.float32).reshape(len(texts), len(self.bias))
        return np.tanh(x + self.bias) @ self.out + self.out_bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.logits(texts) / self.temperature)


def constant(share: float) -> Model:
    """The model whose every score is ``share``."""
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    return Model(Vocabulary({w: i for i, w in enumerate((*SHAPES, AGAIN))}), np.zeros((len(SHAPES) + 1, 1), np.float32), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)


def fit(x: np.ndarray, y: np.ndarray, vocabulary: Vocabulary, vectors: np.ndarray, seed: int = 7) -> Model:
    """The network, by Adam, on four fifths of the pooled documents ``x``; the temperature on the rest."""
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / spread
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(y))
    train, kept = order[len(y) // 5 :], order[: len(y) // 5]
    w = [draw.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for _ in range(40):
        draw.shuffle(train)
        for i in range(0, len(train), 64):
            rows, step = train[i : i + 64], step + 1
            h = np.tanh(z[rows] @ w[0] + w[1])
            miss = (_sigmoid(h @ w[2] + w[3]) - y[rows]) / len(rows)
            back = miss[:, None] * w[2] * (1 - h * h)
            for j, g in enumerate((z[rows].T @ back + 1e-3 * w[0], back.sum(0), h.T @ miss + 1e-3 * w[2], miss.sum(keepdims=True))):
                m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
                w[j] = w[j] - 0.003 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
    first = w[0] / spread[:, None]
    logits = np.tanh(z[kept] @ w[0] + w[1]) @ w[2] + w[3]
    loss = lambda t: -np.mean(np.log(np.clip(_sigmoid(np.where(y[kept] == 1, logits, -logits) / t), 1e-12, 1)))
    temperature = float(min(np.geomspace(0.3, 5, 60), key=loss)) if len(kept) else 1.0
    return Model(vocabulary, (vectors @ first).astype(np.float32), w[1] - mean @ first, w[2], float(w[3][0]), temperature)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Words are counted, their contexts summed and documents pooled on the executors, over the sample as a table.

    The driver gets the words kept with ``DIMS`` numbers each and 2 * ``DIMS`` numbers a sampled document.
    """
    spark = docs.sparkSession
    sample = written(labelled_sample(docs, labels, label, rows).repartition(SAMPLE_PARTS), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, 0):
            for text in batch.column(0).to_pylist():
                counts.update(WORD.findall(text))
        found = list(counts)
        for i in range(0, len(found), 20_000):
            part = found[i : i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], ["word", "n"])

    share = sample.agg(F.avg("y")).first()[0]
    if share is None or share in (0.0, 1.0):
        discard(sample)
        return constant(0.5 if share is None else share)
    counted = sample.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    kept = counted.where(F.col("n") >= MIN_COUNT).orderBy(F.desc("n"), "word").toArrow()["word"].to_pylist()
    vocabulary = Vocabulary({w: i for i, w in enumerate([*SHAPES, AGAIN, *kept])})
    at, sign = index_vectors(list(vocabulary))
    known = spark.sparkContext.broadcast((vocabulary, at, sign))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, at, sign = known.value[0].numbers, *known.value[1:]
        around = np.zeros((len(at), DIMS))
        for batch in slices(batches, 0):
            around += context_sums([numbers(t) for t in batch.column(0).to_pylist()], at, sign)
        found = np.flatnonzero(around.any(1))
        for i in range(0, len(found), 4096):
            part = found[i : i + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([x.tobytes() for x in around[part]], pa.binary())], ["word", "around"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for word, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(raw)
                sums[word] = sums[word] + part if word in sums else part
        found = sorted(sums)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([sums[w].astype(np.float32).tobytes() for w in found], pa.binary())], ["word", "around"])

    # Sums of whole numbers: exact in any order, so the parts may meet in any.
    parts = sample.select("text").mapInArrow(contexts, "word int, around binary").repartition("word").mapInArrow(merged, "word int, around binary").toArrow()
    around = np.zeros((len(vocabulary), DIMS), np.float32)
    if parts.num_rows:
        around[parts["word"].to_numpy()] = np.frombuffer(b"".join(parts["around"].to_pylist()), np.float32).reshape(-1, DIMS)
    vectors = word_vectors(at, sign, around)
    spread = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            x = [pooled(known.value[0].numbers(t), spread.value).astype(np.float32).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["_id", "y", "x"])

    id_type = sample.schema["_id"].dataType.simpleString()
    found = sample.select("_id", "y", "text").mapInArrow(pool, f"_id {id_type}, y int, x binary").toArrow().sort_by([("_id", "ascending"), ("x", "ascending")])
    known.destroy()
    spread.destroy()
    discard(sample)
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float32).reshape(found.num_rows, -1).astype(np.float64)
    return fit(x, found["y"].to_numpy().astype(float), vocabulary, vectors)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the model is broadcast, bounded by the sample."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = held.value.scores([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(float))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; scored and dropped in one pass."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = held.value.scores([x or "" for x in batch.column(text_col).to_pylist()])
            yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(run, docs.schema)
