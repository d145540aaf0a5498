"""Winnowing fingerprints: rolling k-gram hashes, the rightmost minimum of every window, positions kept.

Any run of at least ``window + k - 1`` equal code points in two texts yields at least one equal (hash) pick in both.

Defined results: a null text counts as empty; an empty text has no picks; a text shorter than ``k`` is one gram as
long as itself; a text with fewer grams than ``window`` is one window. Two empty fingerprints are alike (1.0), an
empty and a non-empty one are not (0.0). A null id sorts before all others; rows of equal id are ordered by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.shared import slices

K, WINDOW = 16, 32
_BASE, _SPREAD, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """A 32-bit hash of every k-gram of code points, from hashes of powers of two in length."""
    step = (np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)) * _SPREAD
    k = min(k, len(step))
    if not k:
        return np.zeros(0, np.uint64)
    step ^= step >> _32
    whole, done, length, power = None, 0, 1, _BASE
    while True:
        if k & 1:
            if whole is None:
                whole = step
            else:
                n = len(whole) - length
                whole = whole[:n] * power + step[done : done + n]
            done += length
        k >>= 1
        if not k:
            break
        step = step[:-length] * power + step[length:]
        length, power = 2 * length, np.multiply(power, power)
    whole = whole * _SPREAD
    return ((whole ^ (whole >> _32)) * _BASE) >> _32


def picks(text: str, k: int = K, window: int = WINDOW) -> np.ndarray:
    """The picked grams by position, each as hash << 32 | (2**32 - 1 - position): the least of a window is its rightmost minimum."""
    hashes = gram_hashes(text, k)
    if not len(hashes):
        return hashes
    least = hashes << _32 | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    window, span = min(window, len(least)), 1
    while 2 * span <= window:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < window:
        least = np.minimum(least[: span - window], least[window - span :])
    return least[np.r_[True, least[1:] != least[:-1]]]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _digest(chosen: np.ndarray) -> str:
    return hashlib.sha256(chosen.astype("<u8").tobytes()).hexdigest()[:32]


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """(id, n_chars, hashes, positions, fingerprint) of every row; the arrays are in order of position."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            chosen = [picks(x, k, window) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([(c >> _32).astype(np.int64) for c in chosen], pa.list_(pa.int64())),
                    pa.array([(_LOW - (c & _LOW)).astype(np.int64) for c in chosen], pa.list_(pa.int64())),
                    pa.array([_digest(c) for c in chosen], pa.string()),
                ],
                ["id", "n_chars", "hashes", "positions", "fingerprint"],
            )

    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, n_chars bigint, hashes array<bigint>, positions array<bigint>, fingerprint string"
    )


def _buckets(ids: DataFrame, n: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Bounds that cut the ids into about ``n`` ranges; of each range with rows its number, least id, and the range before it in the circle."""
    at = [i / n for i in range(1, n)] or [0.5]
    bounds = sorted(set(ids.agg(F.percentile_approx("key", at, 10_000).alias("b")).first()["b"] or []))
    least = sorted(tuple(r) for r in ids.groupBy(_range_of(F.col("key"), bounds).alias("bucket")).agg(F.min("key").alias("key")).collect())
    return bounds, [(b, key, least[i - 1][0]) for i, (b, key) in enumerate(least)]


def _range_of(key, bounds: list[int]):
    """How many bounds are at most ``key``: every so many of them are counted first, then those from there on."""
    if not bounds:
        return F.lit(0)
    step = int(len(bounds) ** 0.5) + 1
    held = F.lit(bounds).cast("array<bigint>")
    coarse = F.size(F.filter(F.lit(bounds[step - 1 :: step] or [2**63 - 1]).cast("array<bigint>"), lambda b: b <= key)) * step
    return coarse + F.size(F.filter(F.slice(held, coarse + 1, F.lit(step)), lambda b: b <= key))


def _labels(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions a number that hashes there, so that every bucket has a task of its own."""
    rows = spark.range(32 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("task")).groupBy("task").agg(F.min("id").alias("id")).collect()
    found = {r["task"]: r["id"] for r in rows}
    return [found.get(task, -task) for task in range(n)]


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprint every text and its edit by the following text, and how alike they are.

    Rows are ordered by id; after the last comes the first (a lone row follows itself). The edit replaces the last
    floor(n/2) code points by the first as many of the following text, or by all of it if it is shorter.

    One shuffle of the texts: ranges of ids, cut at quantiles, are sorted and read in order; the first row of a range
    is sent to the range before it too, so no range waits for another. The driver sees a bound and a least id of each
    range only.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    bounds, ranges = _buckets(rows.select("key"), n)
    labels = F.lit(_labels(spark, n)).cast("array<bigint>")
    before = F.create_map(*[x for _, key, prev in ranges for x in (F.lit(key).cast("bigint"), F.lit(prev))]) if ranges else F.lit(None).cast("map<bigint,int>")
    own = F.struct(_range_of(F.col("key"), bounds).alias("bucket"), F.lit(False).alias("follows"))
    head = F.struct(F.element_at(before, F.col("key")).alias("bucket"), F.lit(True).alias("follows"))
    places = F.explode(F.filter(F.array(own, head), lambda p: p["bucket"].isNotNull()))
    dealt = (
        rows.withColumn("place", places)
        .select("id", "key", "text", F.element_at(labels, F.col("place.bucket") + 1).alias("bucket"), "place.follows")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "follows", "key", "text")
        .select("bucket", "follows", "id", "text")
    )

    def row(doc, edit_of):
        (doc_id, text, chosen, hashes), (_, after, _, other) = doc, edit_of
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        new = picks(edited, k, window)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), _digest(chosen), _digest(new),
            likeness(hashes, np.unique(new >> _32)), likeness(hashes, other), len(chosen),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket_held, closed = None, None, False
        for batch in slices(batches, 3):
            out = []
            for bucket, follows, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket == bucket_held and closed:
                    continue  # further rows that share the id of the head
                chosen = picks(text, k, window)
                doc = (doc_id, text, chosen, np.unique(chosen >> _32))
                if bucket == bucket_held:
                    out.append(row(held, doc))
                held, bucket_held, closed = doc, bucket, follows
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_picks"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_picks bigint")
