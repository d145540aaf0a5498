"""Near-duplicate documents: MinHash bands find candidates, odd sketches sift them, full shingle sets confirm.

A document's set is its distinct shingles of five words (A-Z lowered, words split at ASCII white space); with fewer
words the whole sequence is one shingle; without words the set is empty and linked with nothing. Two documents are
linked if 100 * intersection >= 75 * union, counted on the full sets of 64-bit shingle hashes.

* Equal sets are one class, represented by its least id, so copies never meet as pairs.
* ``BANDS`` bands of ``ROWS`` MinHash values: a pair at similarity 0.75 shares no band with probability 1.3e-6.
* The same values, folded into a parity bitmap of ``BITS`` bits: the population count of the XOR of two bitmaps
  estimates the similarity; pairs whose estimate is under 0.5 (over five deviations below 0.75) are not read in full.
* Within a bucket every member is first compared with the least one only. Then only members of one bucket that are
  still in different components are compared: in small buckets as pairs; in large ones those outside the least one's
  component with all others, block by block inside tasks that return links only. Nothing is capped or left out.

Defined results: a null text counts as empty; a row with a null id is linked with nothing and kept, its component
null; an id that stands on several rows with different texts: each text is linked, kept or dropped by itself, so that a
text goes only if it resembles one that stays. Ids are whole numbers (others are cast, which fails for text that is none).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.shared import slices
from tidewire.operators.components import connected_components
from tidewire.sources.shared_folder import discard, written

WORDS, BANDS, ROWS, BITS = 5, 50, 5, 1024
#: Most members of a small bucket; members in one block of those outside the main component, and of all.
SMALL, OUTSIDE, ALL = 24, 256, 1024
#: Differing bits at which the estimate of the similarity, 1 + BITS / (4 * samples) * ln(1 - 2 * differing / BITS), is 0.5.
MOST_BITS = int(BITS / 2 * (1 - np.exp(-2.0 * BANDS * ROWS / BITS))) + 1

_draw = np.random.default_rng(20240229)
_TIMES = _draw.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_PLUS = _draw.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_IN_BAND = _draw.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = _draw.integers(0, 2**63, BANDS, dtype=np.uint64)
_IN_SHINGLE = _draw.integers(0, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_PLACE = _draw.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial in its bytes, mixed."""
    codes = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    blank = _SPACE[codes]
    if blank.all():
        return np.zeros(0, np.uint64)
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    place = np.arange(len(codes)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(codes)]))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), _BASE)])
    values = (codes.astype(np.uint64) + np.uint64(1)) * powers[place]
    values[blank] = 0
    return _mix(np.add.reduceat(values, starts))


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = _word_hashes(text)
    if not len(words):
        return words
    if len(words) < WORDS:
        return _mix((words * _IN_SHINGLE[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
    n = len(words) - WORDS + 1
    whole = words[:n] * _IN_SHINGLE[0]
    for i in range(1, WORDS):
        whole += words[i : i + n] * _IN_SHINGLE[i]
    return np.unique(_mix(whole))


def min_hashes(found: np.ndarray) -> np.ndarray:
    least = np.full(len(_TIMES), 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 512):
        np.minimum(least, (short[i : i + 512, None] * _TIMES + _PLUS).min(0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    return _mix((least.reshape(BANDS, ROWS).astype(np.uint64) * _IN_BAND).sum(1) ^ _BAND)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap: each (function, value) flips one bit."""
    at = _mix(least.astype(np.uint64) + _PLACE) % np.uint64(BITS)
    odd = np.bincount(at.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n, set_key, bands, sketch) of every row; the last three are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys, all_bands, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text or "")
                sizes.append(len(found))
                least = min_hashes(found) if len(found) else None
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                all_bands.append(None if least is None else bands(least).view(np.int64))
                sketches.append(None if least is None else odd_sketch(least).view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(all_bands, longs), pa.array(sketches, longs)],
                ["doc_id", "text_key", "n", "set_key", "bands", "sketch"],
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _text_key(text_col).alias("text_key")).mapInArrow(
        run, "doc_id bigint, text_key bigint, n bigint, set_key binary, bands array<bigint>, sketch array<bigint>"
    )


def _text_key(text_col: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of the wanted (id, rep, set_key): the set is that of a text of document ``rep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [shingles(x) for x in batch.column(1).to_pylist()]
            keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["rep", "set_key", "shingles"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("rep"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    made = texts.join(wanted.select("rep"), "rep", "left_semi").mapInArrow(run, "rep bigint, set_key binary, shingles array<bigint>")
    return made.join(wanted, ["rep", "set_key"]).dropDuplicates(["id"]).select("id", "shingles")


def _differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x)


def _sifted(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) whose sizes and sketches allow a link."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    return (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(side("a"), "a")
        .join(side("b"), "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * 75)
        .where(_differing(F.col("sketch_a"), F.col("sketch_b")) <= MOST_BITS)
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b") - common).alias("union")).where("100 * common >= 75 * union").select("a", "b")


def links(docs: DataFrame, reps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Confirmed links (a, b) that join every two representatives whose sets are linked through any chain."""
    placed = reps.select("id", F.explode("bands").alias("bucket"))
    # A table of its own: the join below may be a broadcast, by its size, or split where a bucket is crowded.
    shared = written(placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("pivot")).where("size > 1"), "shared")
    members = written(placed.join(shared, "bucket"), "members")
    sets = written(_sets(docs, reps.select("id", "rep", "set_key").join(members.select("id").distinct(), "id", "left_semi"), id_col, text_col), "sets")
    stars = members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    found = written(_confirmed(_sifted(stars, reps), sets), "links")
    still_open = _still_open(members, connected_components(found))
    small = still_open.where(f"size <= {SMALL}")
    left, right = (small.select("bucket", F.col("id").alias(x), F.col("part").alias(f"part_{x}")) for x in "ab")
    pairs = left.join(right, "bucket").where("a < b and part_a <> part_b").select("a", "b")
    every = found.unionAll(written(_confirmed(_sifted(pairs, reps), sets), "links")).unionAll(written(_across(still_open.where(f"size > {SMALL}"), sets), "links"))
    for table in (shared, members, sets, still_open):
        discard(table)
    return every


def _still_open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The members of buckets that lie in more than one component, each with its own and its pivot's."""
    of = lambda x, y: parts.select(F.col("id").alias(x), F.col("component").alias(y))
    own = (
        members.join(of("id", "own"), "id", "left")
        .join(of("pivot", "its"), "pivot", "left")
        .select("bucket", "id", "size", F.coalesce("own", "id").alias("part"), F.coalesce("its", "pivot").alias("pivot_part"))
    )
    split = own.where("part <> pivot_part").select("bucket").distinct()
    return written(own.join(split, "bucket", "left_semi"), "open")


def _across(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between those outside a large bucket's main component and all that share such a bucket with them.

    The buckets around one component are taken together. Who is outside goes in blocks of ``OUTSIDE``, all who are
    there in blocks of ``ALL``, by classes of set size of which only neighbours can be linked; each task counts the
    common shingles of one block with one other and returns a link for each member and component.
    """
    size = F.floor(F.log(F.size("shingles").cast("double")) / float(np.log(4 / 3))).cast("int")
    all_ = written(large.groupBy("pivot_part", "id").agg(F.first("part").alias("part")).join(sets, "id").withColumn("class", size), "around")
    outside = all_.where("part <> pivot_part").withColumn("class", F.explode(F.array(*(F.col("class") + i for i in (-1, 0, 1)))))
    counts = lambda df, most, name: df.groupBy("pivot_part", "class").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    # A table of its own, so that the joins with it may be broadcasts, by its size, or split where a group is crowded.
    blocks = written(counts(outside, OUTSIDE, "n_out").join(counts(all_, ALL, "n_all"), ["pivot_part", "class"]), "blocks")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["pivot_part", "class", "o", "i"]
    outer = outside.join(blocks, ["pivot_part", "class"]).withColumn("o", own("n_out")).withColumn("i", each("n_all")).select(*keys, "id", "part", "shingles")
    inner = all_.join(blocks, ["pivot_part", "class"]).withColumn("i", own("n_all")).withColumn("o", each("n_out")).select(*(F.col(c).alias(c) for c in (*keys, "id", "part", "shingles")))

    def linked(outer: pa.Table, inner: pa.Table) -> pa.Table:
        ids, parts = inner["id"].to_numpy(), inner["part"].to_numpy()
        lists = inner["shingles"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat, whose = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, whose, got = flat[order], whose[order], []
        for one, part, own_set in zip(outer["id"].to_pylist(), outer["part"].to_pylist(), outer["shingles"].to_pylist(), strict=True):
            own_set = np.array(own_set, np.int64)
            lo, hi = np.searchsorted(flat, own_set, "left"), np.searchsorted(flat, own_set, "right")
            n = hi - lo
            at = np.arange(n.sum()) + np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) if n.any() else np.zeros(0, np.int64)
            common = np.bincount(whose[at], minlength=len(ids))
            near = np.flatnonzero((100 * common >= 75 * (len(own_set) + sizes - common)) & (parts != part))
            if len(near):
                _, firsts = np.unique(parts[near], return_index=True)
                got += [(one, int(ids[near[f]])) for f in firsts]
        return pa.table({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([x for _, x in got], pa.int64())})

    return outer.groupBy(*keys).cogroup(inner.groupBy(*keys)).applyInArrow(linked, "a bigint, b bigint")


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row."""
    made = written(prints(docs, id_col, text_col), "prints")
    classes = written(made.where("n > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    # The number of a class is its least document's; where that is the least of several classes, all but one have a hash.
    own = classes.groupBy("rep").agg(F.min("set_key").alias("own_key"))
    named = F.when(F.col("set_key") == F.col("own_key"), F.col("rep")).otherwise(F.xxhash64("rep", "set_key"))
    numbered = written(classes.join(own, "rep").select("set_key", "rep", named.alias("id")), "numbered")
    mine = (made["doc_id"] == numbered["rep"]) & (made["set_key"] == numbered["set_key"])
    reps = written(made.join(numbered, mine).select("id", "rep", made["set_key"], "n", "bands", "sketch").dropDuplicates(["id"]), "reps")
    parts = connected_components(links(docs, reps, id_col, text_col)).select("id", F.col("component").alias("part"))
    linked = numbered.join(parts, "id").select("set_key", "rep", "part")
    least = linked.groupBy("part").agg(F.min("rep").alias("component"))
    of_class = classes.join(linked.join(least, "part").select("set_key", "component"), "set_key", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    joined = made.select("doc_id", "text_key", "n", "set_key").join(of_class, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _judged(docs, id_col, text_col).drop("text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is their component's least one, and those without an id."""
    gone = _judged(docs, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_text")).distinct()
    same = (docs[id_col].cast("bigint") == F.col("_gone_id")) & (_text_key(text_col) == F.col("_gone_text"))
    return docs.join(gone, same, "left_anti").select(*(docs[c] for c in docs.columns))


#: ``near_duplicates`` in DuckDB's SQL, by counting common shingles.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), edges AS (
  SELECT a, b FROM pairs WHERE 100 * c >= 75 * (n + m - c)
), both_ways AS (
  SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges
), walk AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT w.a, e.b FROM walk w JOIN both_ways e ON w.b = e.a
), parts AS (
  SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM sets s JOIN parts p ON s.doc_id = p.doc_id
"""
