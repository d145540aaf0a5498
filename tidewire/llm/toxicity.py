"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text, with exception phrases.

Folding lowers case, drops accents and joins look-alikes: letters of other scripts that look Latin, full-width forms,
and digits or signs that stand for letters inside a word ("1d10t"). An entry matches where a word begins with it, and
the longest entry wins. Entries and weights are learned: word beginnings whose document counts lean to one label, from
at most ``SAMPLE_ROWS`` labelled training documents, counted on the executors; a logistic curve turns the document's
features, all relative to its length, into a probability.

Scoring reads every whole text. Defined results: a null text counts as empty; an empty text gets the curve's answer to
no match; without labelled rows the lexicon is empty and every score 0.5, with one label only it is that label's share.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.shared import fold as fold_of
from tidewire.llm.shared import labelled_sample, slices

SAMPLE_ROWS, MIN_DOCS, MIN_LEAN, MAX_ENTRIES, PREFIXES = 20_000, 8, 1.5, 4_000, range(3, 13)

# Characters of other scripts that look like Latin letters.
CYRILLIC, CYRILLIC_AS = "авекмнорстухіјѕԁԛԝһ", "abekmhopctyxijsdqwh"
GREEK, GREEK_AS = "αβεικμνορτυχωγ", "abeikuvoptuxwy"
OTHER, OTHER_AS = "ıłøđħŧɑɡɩʏ", "ilodhtagiy"
# Digits and signs that stand for a letter inside a word.
DIGITS, DIGITS_AS = "0134578@$", "oieastbas"
# Phrases in which a word of abuse is none.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "trash collection", "class clown", "clown fish", "pond scum", "sore loser bracket")


def _table() -> np.ndarray:
    """Code point to folded code point, for the basic plane."""
    to = np.arange(0x10000, dtype=np.uint32)
    alike = dict(zip(CYRILLIC + GREEK + OTHER, CYRILLIC_AS + GREEK_AS + OTHER_AS, strict=True))
    for code in range(0x80, 0x10000):
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xD800:
            continue
        c = alike.get(chr(code).lower(), "") or unicodedata.normalize("NFKD", chr(code)).lower()[:1]
        to[code] = ord(alike.get(c, c) or " ")
    to[65:91] += 32
    return to


_FOLD = _table()
_SUBSTITUTE = str.maketrans(DIGITS, DIGITS_AS)
#: Runs of letters, digits and signs that aren't letters alone; each is entered at its beginning only, so the time is linear.
_MIXED = re.compile(r"(?<![a-z0-9@$])[a-z]*+[0-9@$][a-z0-9@$]*+")
_LETTER = re.compile(r"[a-z]")
_MARKS = re.compile(r"[̀-ͯ]")
_BETWEEN = re.compile(r"[\W_]+")


def folded(text: str) -> str:
    """Words in folded letters, each after one space."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not text.isascii():
        codes = np.where(codes < 0x10000, _FOLD[np.minimum(codes, 0xFFFF)], codes)
        codes = codes[(codes < 0x300) | (codes > 0x36F)]
    else:
        codes = _FOLD[codes]
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    text = _MIXED.sub(lambda m: m[0].translate(_SUBSTITUTE) if _LETTER.search(m[0]) else m[0], text)
    return " " + _BETWEEN.sub(" ", text).strip(" ")


@dataclass
class Model:
    entries: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: np.ndarray = field(default_factory=lambda: np.zeros(6))
    _automaton: object = None

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.entries.items():
                self._automaton.add_word(" " + entry, weight)
            for phrase in self.exceptions:
                self._automaton.add_word(folded(phrase), 0.0)
            self._automaton.make_automaton()
        return self._automaton

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def features(self, text: str) -> np.ndarray:
        """Of the positive and the negative matches: weight for each word, and weight softened by length; the heaviest match; 1."""
        text = folded(text)
        words = max(text.count(" "), 1)
        found = np.fromiter((w for _, w in self.automaton().iter_long(text)), float) if len(text) > 1 and len(self.automaton()) else np.zeros(0)
        up, down = found[found > 0].sum(), -found[found < 0].sum()
        return np.array([up / words, up / np.sqrt(words), np.log1p(up), down / words, found.max(initial=0.0), 1.0])

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 6)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


def _beginnings(text: str) -> set[str]:
    words = {w for w in folded(text).split(" ") if w}
    return {w[:n] for w in words for n in PREFIXES if n <= len(w)} | words


def lexicon(sample: DataFrame) -> dict[str, float]:
    """Weight of every entry kept: the log of how much likelier a document with it is to bear the label.

    Documents are counted on the executors, by partition and then by entry; what reaches the driver are the entries
    above the thresholds, of which at most ``MAX_ENTRIES`` stay. A longer entry stays only if it says something that
    the longest shorter one doesn't.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in slices(batches, 0):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(_beginnings(text))
        terms = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(terms), 50_000):
            part = terms[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([seen[1][t] for t in part], pa.int64()), pa.array([seen[0][t] for t in part], pa.int64())], ["term", "bad", "good"])

    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = sample.select("text", "y").mapInArrow(count, "term string, bad bigint, good bigint").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    lean = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    kept = (
        counts.withColumn("lean", lean)
        .where((F.col("bad") + F.col("good") >= MIN_DOCS) & ((F.col("lean") >= MIN_LEAN) | (F.col("lean") <= -2 * MIN_LEAN)))
        .orderBy((F.abs("lean") * F.log(F.col("bad") + F.col("good"))).desc(), "term")
        .limit(MAX_ENTRIES)
        .collect()
    )
    support = {r["term"]: r["bad"] if r["lean"] > 0 else r["good"] for r in kept}
    # A beginning that a longer one explains says less: "tra" where every document with it has "trash".
    told = {t[:n] for t, has in support.items() for n in range(1, len(t)) if t[:n] in support and has >= 0.95 * support[t[:n]]}
    kept = [r for r in kept if r["term"] not in told]
    entries: dict[str, float] = {}
    for r in sorted(kept, key=lambda r: (len(r["term"]), r["term"])):
        shorter = next((entries[r["term"][:n]] for n in range(len(r["term"]) - 1, 0, -1) if r["term"][:n] in entries), None)
        if shorter is None or abs(shorter - r["lean"]) > 0.5:
            entries[r["term"]] = float(r["lean"])
    return entries


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, on features of unit spread, slightly ridged."""
    spread = x.std(0) + 1e-9
    spread[-1] = 1.0
    z, w = x / spread, np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
    return w / spread


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Entries from half of the sample, the curve from the other half, so that it sees entries as they do on new texts."""
    sample = labelled_sample(docs, labels, label, rows).select("_id", "text", "y")
    half = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(2)) == 0
    model = Model(lexicon(sample.where(half)), exceptions)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = [held.value.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    rest = sample.where(~half).select("text", "y").mapInArrow(run, "x array<double>, y int").collect()
    y = np.array([r["y"] for r in rest], float)
    if len(set(y.tolist())) == 2:
        order = sorted(range(len(rest)), key=lambda i: (rest[i]["x"], rest[i]["y"]))
        model.curve = _curve(np.array([rest[i]["x"] for i in order]), y[order])
    elif len(y):
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        model.curve = np.array([0, 0, 0, 0, 0, np.log(share / (1 - share))])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the model is broadcast, bounded by ``MAX_ENTRIES``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = held.value.scores([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(float))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
