"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A chunk ends after a byte where the gear hash of the last ``WINDOW`` bytes is below a threshold, once in ``MEAN`` bytes
on average, but not within ``SHORTEST`` bytes, so an insertion moves only the ends around it; a chunk of ``LONGEST``
bytes ends in any case. Ends are
moved to the end of a character. A chunk is repeated if its 96-bit digest occurs elsewhere, in another text or
earlier in the same one; the first occurrence, by id, row and place, is the one to keep.

Runs of adjacent repeated chunks of at least ``LEAST`` characters count as repeated passages; shorter ones, common
words mostly, are left alone. A passage of ``LEAST`` characters besides the chunks at its two ends is found wherever
it stands.

Defined results: a null text counts as empty and has no chunks; every row is a text of its own, also where ids repeat
or are null; a null id comes after all others, and rows of one id stand in the order in which the table is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.shared import slices
from tidewire.sources.shared_folder import written

WINDOW, SHORTEST, MEAN, LONGEST, LEAST = 16, 12, 24, 1024, 80
#: A chunk that makes up more than one in so many is hot; there are fewer hot ones than that, so they are broadcast.
HOT = 1_000

_GEAR = np.random.default_rng(16).integers(0, 2**16, 256, dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The hash at each byte: sum of gear[b] << age over the last ``WINDOW`` bytes, modulo 2**16."""
    rolled, span = _GEAR[data], 1
    while span < WINDOW:
        longer = rolled.copy()
        longer[span:] += rolled[:-span] << np.uint16(span)
        rolled, span = longer, 2 * span
    return rolled


def ends(data: bytes) -> list[int]:
    """Where the chunks of UTF-8 bytes end."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return []
    found = np.flatnonzero(gear(codes) < 65536 // MEAN) + 1
    kept, last = [], 0
    for end in found.tolist():
        if end - last >= SHORTEST:
            kept.append(end)
            last = end
    found = np.unique(np.array([*kept, len(codes)]))
    gaps = np.diff(np.r_[0, found])
    if gaps.max() > LONGEST:
        found = np.unique(np.concatenate([found, *(np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(found[gaps > LONGEST], gaps[gaps > LONGEST], strict=True))]))
    inside = (codes & 0xC0) == 0x80
    if inside.any():
        # never inside a character
        start = np.r_[~inside, True]
        following = np.flatnonzero(start)
        found = np.unique(following[np.searchsorted(following, found)])
    return found.tolist()


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, start, length, high, low, again) of every chunk: its row's number, its place in code points, its
    digest, and whether it occurs earlier in the text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["row", "doc_id", "start", "length", "high", "low", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            rows, digests, starts, lengths, again = [], [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                data = (text or "").encode()
                at = ends(data)
                if not at:
                    continue
                own = [hashlib.blake2b(data[a:b], digest_size=12).digest() for a, b in zip([0, *at], at, strict=False)]
                first = {digest: j for j, digest in reversed(list(enumerate(own)))}
                again.append(np.array([first[digest] != j for j, digest in enumerate(own)]))
                digests += own
                places = np.array([0, *at])
                if len(data) != len(text):
                    places = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)][places]
                starts.append(places[:-1])
                lengths.append(np.diff(places))
                rows.append(np.full(len(at), i))
            if digests:
                parts = np.frombuffer(b"".join(digests), np.dtype([("high", "<i8"), ("low", "<i4")]))
                whose = pa.array(np.concatenate(rows))
                columns = [batch.column(0).take(whose), batch.column(1).take(whose), *(pa.array(np.concatenate(x), pa.int32()) for x in (starts, lengths))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(parts["high"].copy()), pa.array(parts["low"].copy()), pa.array(np.concatenate(again))], names)

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"row bigint, doc_id {id_type}, start int, length int, high bigint, low int, again boolean")


def _in_order(cut: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The chunks with their rows numbered in order of the id, and (row, doc_id) unless the number is the id itself."""
    rows = cut.groupBy("row").agg(F.first("doc_id").alias("doc_id"))
    if isinstance(cut.schema["doc_id"].dataType, T.IntegralType) and rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return cut.withColumn("row", F.col("doc_id").cast("bigint")), None
    ranks = written(rows.orderBy(F.col("doc_id").asc_nulls_last(), "row").select(F.col("row").alias("was"), "doc_id", F.monotonically_increasing_id().alias("row")), "rows")
    return cut.withColumnRenamed("row", "was").join(ranks.select("was", "row"), "was").drop("was"), ranks.select("row", "doc_id")


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, start, end, surplus, shared) of every repeated passage, in code points.

    ``shared``: it also stands in another row. ``surplus``: all of its chunks have an earlier occurrence, so it may go.
    A passage that is surplus in part is given in adjacent rows, the surplus ones of at least ``least`` characters each.

    The texts are cut once, into a table. Chunks are counted by digest before any join, on the map side first; those of
    a hot digest meet its count by broadcast, the others by a shuffle in which no digest has more than one in ``HOT``
    of the rows. Runs are formed within the row.
    """
    cut, ids = _in_order(written(chunks(docs, id_col, text_col), "chunks"))
    counted = cut.groupBy("high", "low").agg(F.count("*").alias("times"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))
    repeats = written(counted.where("times > 1").select("high", "low", "times", "first_row", (F.col("first_row") < F.col("last_row")).alias("shared")), "repeats")
    total, key, told = cut.count(), ["high", "low"], ["first_row", "shared"]
    hot, own = F.broadcast(repeats.where(F.col("times") * HOT > total).select(*key, *told)), cut.select("row", "start", "length", "again", *key)
    cold = own.join(hot.select(*key), key, "left_anti").join(repeats.where(F.col("times") * HOT <= total).select(*key, *told), key)
    again = cold.drop(*key).unionByName(own.join(hot, key).drop(*key))
    again = again.select("row", "start", (F.col("start") + F.col("length")).alias("end"), "shared", ((F.col("row") != F.col("first_row")) | F.col("again")).alias("surplus"))
    # Runs of adjacent chunks, in pieces that are alike in being surplus.
    before = Window.partitionBy("row").orderBy("start")
    opens = F.coalesce(F.col("start") != F.lag("end").over(before), F.lit(True))
    turns = opens | (F.col("surplus") != F.lag("surplus").over(before))
    so_far = before.rowsBetween(Window.unboundedPreceding, 0)
    cuts = again.withColumns({"opens": opens.cast("int"), "turns": turns.cast("int")})
    cuts = cuts.withColumns({"run": F.sum("opens").over(so_far), "piece": F.sum("turns").over(so_far)})
    span = [F.min("start").alias("start"), F.max("end").alias("end"), F.max("surplus").alias("surplus"), F.max("shared").alias("shared")]
    pieces = cuts.groupBy("row", "run", "piece").agg(*span)
    # The whole run has to be long enough; a surplus piece in it that is not stays with the pieces beside it.
    run = Window.partitionBy("row", "run")
    held = pieces.withColumn("chars", F.max("end").over(run) - F.min("start").over(run)).where(F.col("chars") >= least)
    held = held.withColumn("surplus", F.col("surplus") & (F.col("end") - F.col("start") >= least))
    along = run.orderBy("piece")
    held = held.withColumn("turns", F.coalesce(F.col("surplus") != F.lag("surplus").over(along), F.lit(True)).cast("int"))
    held = held.withColumn("part", F.sum("turns").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    found = held.groupBy("row", "run", "part").agg(*span)
    named = found.withColumn("doc_id", F.col("row").cast(docs.schema[id_col].dataType)) if ids is None else found.join(ids, "row")
    return named.select("doc_id", "start", "end", "surplus", "shared")
