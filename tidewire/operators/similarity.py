"""Set similarity: scores as columns, and joins that find all pairs above a threshold without comparing all."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.components import connected_components
from tidewire.sources.shared_folder import discard, written


def common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """0 if either side is empty or null."""
    both = common(a, b)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0), common(a, b) / F.least(F.size(a), F.size(b))).otherwise(0.0)


def title_similarity(a: Column, b: Column) -> Column:
    """0.7 of the containment and 0.3 of the Jaccard similarity, to four places."""
    return F.floor((0.7 * overlap(a, b) + 0.3 * jaccard(a, b)) * 10_000 + 0.5) / 10_000


def set_classes(df: DataFrame, id_col: str, set_col: str) -> tuple[DataFrame, DataFrame]:
    """(representatives, membership): rows of equal sets are one class under its least id, so copies never form pairs."""
    sets = df.select(F.col(id_col).alias("id"), F.array_sort(set_col).alias("set"))
    # Empty sets go after the table is written: a filter before would be computed from the text a second time.
    keyed = written(sets.withColumn("key", F.sha2(F.array_join("set", "\x1f"), 256)), "keyed").where(F.size("set") > 0)
    least = keyed.groupBy("key").agg(F.min("id").alias("rep"))
    members = written(keyed.select("id", "key").join(least, "key"), "members")
    reps = keyed.join(members.where("id = rep").select("id", "key").distinct(), ["id", "key"]).select("id", "set")
    return reps, members.select("id", "rep")


#: The most frequent elements that are numbered.
NUMBERED = 131_072
#: Least cells of elements in a band of sizes, and rows for each further one; least parts and rows whose sets are compared in one.
CELLS, PER_CELL, PARTS, PER_PART = 4, 196_608, 12, 4_096
#: First elements of a set by which a pair finds the one cell that tells it.
LEADING = 8
#: Rows made, elements of a cell sorted, and hits compared, at once.
_ROWS, _ELEMENTS, _HITS = 1_024, 500_000, 250_000


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """start, start + 1, ... end - 1 of each range in turn."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the rows' elements, the rows of the elements, the elements."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    return starts, np.repeat(np.arange(len(lists)), np.diff(starts)), lists.flatten().to_numpy()


def _listed(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Values, in order of their rows, as a list for each of n rows."""
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32), pa.array(values))


def _numbered(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements (e, n), ascending, and their numbers, from the rarest; as many whole frequencies as ``NUMBERED`` has room for."""
    least, room = None, NUMBERED
    for n, held in sorted(((r.n, r.held) for r in counts.groupBy("n").agg(F.count("*").alias("held")).collect()), reverse=True):
        room -= held
        if room < 0:
            break
        least = n
    if least is None:
        return np.array([], np.int64), np.array([], np.int32)
    top = counts.where(F.col("n") >= least).toArrow()
    e, n = top["e"].to_numpy(), top["n"].to_numpy()
    known, numbers = np.sort(e), np.empty(len(e), np.int32)
    numbers[np.searchsorted(known, e[np.lexsort((e, n))])] = np.arange(len(e))
    return known, numbers


def _coded(known: np.ndarray, numbers: np.ndarray) -> Callable:
    """(id, key, rest, codes) of each set: elements that have no number, in order, and the numbers of the others; equal sets have equal keys."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, rows, values = _lists(batch["set"])
            at = np.searchsorted(known, values)
            at[at == len(known)] = 0
            has = known[at] == values if len(known) else np.zeros(len(values), bool)
            codes = np.sort(rows[has] << 32 | numbers[at[has]])
            rest_rows, rest = rows[~has], values[~has]
            order = np.lexsort((rest, rest_rows))
            rest_rows, rest, code_rows, codes = rest_rows[order], rest[order], codes >> 32, (codes & 0x7FFFFFFF).astype(np.int32)
            r, c = (np.concatenate([[0], np.cumsum(np.bincount(x, minlength=len(batch)))]) for x in (rest_rows, code_rows))
            told = (r[1:] - r[:-1]).astype(np.int32)
            keys = [int.from_bytes(hashlib.blake2b(told[i].tobytes() + rest[r[i] : r[i + 1]].tobytes() + codes[c[i] : c[i + 1]].tobytes(), digest_size=8).digest(), "little", signed=True) for i in range(len(batch))]
            made = {"id": batch["id"], "key": pa.array(keys, pa.int64()), "rest": _listed(rest_rows, rest, len(batch)), "codes": _listed(code_rows, codes, len(batch))}
            yield pa.RecordBatch.from_pydict(made).filter(pa.array(np.diff(starts) > 0))

    return code


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _cell(seen: np.ndarray, cells: int) -> np.ndarray:
    return (_spread(seen.astype(np.int32).view(np.uint32).astype(np.uint64)) % np.uint64(cells)).astype(np.int64)


def _prefix(size: np.ndarray, threshold: float) -> np.ndarray:
    return size - np.ceil(size * threshold - 1e-6).astype(np.int64) + 1


def _edges(threshold: float, most: int) -> np.ndarray:
    """Where bands of sizes begin: a set is similar to those of its band, the one before and the one behind only."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(int(edges[-1] / threshold + 1e-6) + 1)
    return np.array(edges)


def _need(threshold: float, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Elements that sets of these sizes have in common if they are similar."""
    return np.ceil(threshold / (1 + threshold) * (size + other) - 1e-6).astype(np.int64)


def _dealt(threshold: float, cells: int) -> Callable:
    """(cell, id, key, size, bits, leading, elements, places): a set in each cell that elements of its prefix fall into, with those and their places in its order.

    Cells are of a band of sizes. A set goes to those of its own and, as the smaller one of pairs, to those of the next band.
    ``bits`` has a bit for every element of the whole set, a power of two of them and twice as many as elements at
    least; ``leading`` are the first elements of the prefix, wherever they fall.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, _ROWS) for i in range(0, len(whole), _ROWS)):
                (r, rest_rows, rest), (c, code_rows, codes) = _lists(batch["rest"]), _lists(batch["codes"])
                size = np.diff(r) + np.diff(c)
                rows = np.concatenate([rest_rows, code_rows])
                places = np.concatenate([np.arange(len(rest)) - r[rest_rows], np.arange(len(codes)) - c[code_rows] + np.diff(r)[code_rows]])
                mixed = _spread(np.concatenate([rest.view(np.uint64), codes.astype(np.uint64)]))
                width = 64 << np.ceil(np.log2(np.maximum(2 * size, 64) / 64)).astype(np.int64)
                ends = np.cumsum(width)
                flags = np.zeros(ends[-1] if len(ends) else 0, bool)
                flags[(ends - width)[rows] + (mixed & (width[rows] - 1).astype(np.uint64)).astype(np.int64)] = True
                bits = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(np.concatenate([[0], ends // 8]).astype(np.int32)), pa.py_buffer(np.packbits(flags, bitorder="little"))])
                # Two elements that look the same here give a hit too many, which the whole sets rule out.
                seen = np.concatenate([(rest.view(np.uint64) >> np.uint64(33)).astype(np.int64) - 2**31, codes]).astype(np.int32)
                prefix = places < _prefix(size, threshold)[rows]
                rows, places, seen = rows[prefix], places[prefix], seen[prefix]
                leading = np.zeros((len(batch), LEADING), np.int32)
                leading[rows[places < LEADING], places[places < LEADING]] = seen[places < LEADING]
                leading = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(np.arange(len(batch) + 1, dtype=np.int32) * 4 * LEADING), pa.py_buffer(leading)])
                edges = _edges(threshold, size.max(initial=0))
                band = np.searchsorted(edges, size, "right") - 1
                guest = places < (size - _need(threshold, size, edges[band + 1]) + 1)[rows]
                at = np.concatenate([band[rows] * cells + _cell(seen, cells), (band[rows] + 1)[guest] * cells + _cell(seen[guest], cells)])
                rows, places, seen = (np.concatenate([x, x[guest]]) for x in (rows, places, seen))
                bound = (len(edges) + 1) * cells
                at += rows * bound
                order = np.argsort(at, kind="stable")
                held, own = np.unique(at, return_inverse=True)
                of = held // bound
                made = {
                    "cell": pa.array(held % bound, pa.int32()), "id": batch["id"].take(pa.array(of)), "key": batch["key"].take(pa.array(of)), "size": pa.array(size[of], pa.int32()), "bits": bits.take(pa.array(of)), "leading": leading.take(pa.array(of)),
                    "elements": _listed(own, seen[order], len(held)), "places": _listed(own, places[order].astype(np.int32), len(held)),
                }
                yield pa.RecordBatch.from_pydict(made)

    return deal


def _differing(bits: dict[int, tuple[np.ndarray, np.ndarray]], width: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """In how many bits the maps of y and x differ, the wider one folded to the other's width: sets differ in at least as many elements."""
    out = np.zeros(len(y), np.int64)
    pair = width[y] << 32 | width[x]
    for both in np.unique(pair):
        z, w, v = np.flatnonzero(pair == both), int(both >> 32), int(both & 0xFFFFFFFF)
        (of_y, a), (of_x, b) = bits[w], bits[v]
        for part in (z[i : i + 65_536] for i in range(0, len(z), 65_536)):
            p, q = a[of_y[y[part]]], b[of_x[x[part]]]
            while p.shape[1] > q.shape[1]:
                p = p[:, : p.shape[1] // 2] | p[:, p.shape[1] // 2 :]
            while q.shape[1] > p.shape[1]:
                q = q[:, : q.shape[1] // 2] | q[:, q.shape[1] // 2 :]
            out[part] = np.bitwise_count(p ^ q).sum(1, dtype=np.int64)
    return out


def _told_in(leading: np.ndarray, size: np.ndarray, y: np.ndarray, x: np.ndarray, need: np.ndarray, threshold: float, cells: int) -> np.ndarray:
    """The cell of the first hit among the leading elements of each pair; -1 if it has none."""
    out, length = np.full(len(y), -1), np.minimum(_prefix(size, threshold), LEADING)
    for i in range(LEADING):
        for j in range(LEADING):
            some = np.flatnonzero((out < 0) & (leading[y, i] == leading[x, j]) & (length[y] > i) & (length[x] > j) & (np.minimum(size[y] - i, size[x] - j) >= need))
            out[some] = _cell(leading[y[some], i], cells)
    return out


def _binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the rows' bytes, and all their bytes."""
    whole = column.combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    _, offsets, data = whole.buffers()
    starts = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1]
    return starts, np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]


def _hits(seen: np.ndarray, place: np.ndarray, doc: np.ndarray, size: np.ndarray, smallest: int, bits: dict, width: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs of sets, numbered by size, that share an element and may be similar; the larger one has at least the smallest size."""
    order = np.lexsort((doc, seen))
    seen, place, doc = seen[order], place[order], doc[order]
    s = size[doc]
    at = seen << 31 | s
    # Of a run of one element, by size, the row of the smaller set meets those after it up to the size that leaves room for enough common ones.
    most = np.minimum(s / threshold, (s - place + 1e-6) * (1 + threshold) / threshold - s)
    last = np.searchsorted(at, seen << 31 | np.maximum(most + 1e-6, 0).astype(np.int64), "right")
    begin = np.maximum(np.arange(1, len(seen) + 1), np.searchsorted(at, seen << 31 | smallest, "left"))
    last = np.maximum(last, begin)
    hits, found, now = np.cumsum(last - begin), [np.array([], np.int64)], 0
    while now < len(seen):
        upto = max(now + 1, int(np.searchsorted(hits, (hits[now - 1] if now else 0) + _HITS, "right")))
        y, x = np.repeat(np.arange(now, upto), last[now:upto] - begin[now:upto]), ranges(begin[now:upto], last[now:upto])
        need = _need(threshold, s[x], s[y])
        # Of a similar pair the first element in common leaves room in both orders.
        fit = (s[y] >= threshold * s[x] - 1e-6) & (np.minimum(s[x] - place[x], s[y] - place[y]) >= need)
        y, x, need = doc[y[fit]], doc[x[fit]], need[fit]
        fit = size[y] + size[x] - _differing(bits, width, y, x) >= 2 * need
        found.append(np.unique(y[fit] << 32 | x[fit]))
        now = upto
    return np.unique(np.concatenate(found))


_PAIR = "a bigint, key_a bigint, b bigint, key_b bigint"


def _meet(threshold: float, cells: int) -> Callable:
    """The pairs that share an element of the cell and may be similar, a the lesser id; of rows of equal sets only the least id.

    Pairs that meet by one of their leading elements are told in that one's cell only.
    """

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        band, cell = divmod(key[0].as_py(), cells)
        ids, keys, size = (table[c].to_numpy() for c in ("id", "key", "size"))
        order = np.lexsort((ids, size, keys))
        first = np.ones(len(order), bool)
        first[1:] = (keys[order][1:] != keys[order][:-1]) | (size[order][1:] != size[order][:-1])
        kept = order[first]
        kept = kept[np.argsort(size[kept], kind="stable")]
        number = np.full(len(ids), -1, np.int32)
        number[kept] = np.arange(len(kept))
        ids, keys, size = ids[kept], keys[kept], size[kept].astype(np.int64)
        leading = _binary(table["leading"].take(pa.array(kept)))[1].view(np.int32).reshape(-1, LEADING)
        width, bits = pc.binary_length(table["bits"]).to_numpy().astype(np.int64)[kept] * 8, {}
        for w in np.unique(width):
            own, of = np.flatnonzero(width == w), np.full(len(width), -1, np.int32)
            of[own] = np.arange(len(own))
            bits[int(w)] = of, _binary(table["bits"].take(pa.array(kept[own])))[1].view(np.uint64).reshape(len(own), -1)
        _, rows, seen = _lists(table["elements"])
        place, doc = _lists(table["places"])[2], number[rows]
        smallest, found = _edges(threshold, size.max(initial=0))[band], [np.array([], np.int64)]
        parts = len(seen) // _ELEMENTS + 1
        part = _spread(seen.view(np.uint32).astype(np.uint64) + np.uint64(1)) % np.uint64(parts) if parts > 1 else np.zeros(len(seen), np.uint64)
        for turn in range(parts):
            some = np.flatnonzero((part == turn) & (doc >= 0))
            found.append(_hits(seen[some].astype(np.int64) + 2**31, place[some].astype(np.int64), doc[some].astype(np.int64), size, smallest, bits, width, threshold))
        pairs = np.unique(np.concatenate(found))
        y, x = pairs >> 32, pairs & 0xFFFFFFFF
        parts = [slice(i, i + _HITS) for i in range(0, len(y), _HITS)]
        told = np.concatenate([np.array([], np.int64), *(_told_in(leading, size, y[p], x[p], _need(threshold, size[y[p]], size[x[p]]), threshold, cells) for p in parts)])
        fit = (ids[y] != ids[x]) & ((told < 0) | (told == cell))
        y, x = y[fit], x[fit]
        a, b = np.where(ids[y] < ids[x], y, x), np.where(ids[y] < ids[x], x, y)
        return pa.table({"a": ids[a], "key_a": keys[a], "b": ids[b], "key_b": keys[b]})

    return meet


def _confirmed(threshold: float) -> Callable:
    """(a, b, similarity) of the pairs whose whole sets are similar enough."""

    def confirm(key: tuple[pa.Scalar, ...], pairs: pa.Table, sets: pa.Table) -> pa.Table:
        known = np.argsort(sets["key"].to_numpy())
        row = lambda keys: known[np.searchsorted(sets["key"].to_numpy(), keys.to_numpy(), sorter=known)]
        (_, rest_rows, rest), (_, code_rows, codes) = _lists(sets["rest"]), _lists(sets["codes"])
        rows = np.concatenate([rest_rows, code_rows])
        order = np.argsort(rows, kind="stable")
        elements = np.unique(np.concatenate([rest, codes.astype(np.int64)]), return_inverse=True)[1]
        # A hash may look like a number; the two stay apart.
        elements = (elements * 2 + np.repeat([0, 1], [len(rest), len(codes)]))[order]
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(sets)))])
        a, b = row(pairs["key_a"]), row(pairs["key_b"])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        common, mark = np.zeros(len(a), np.int64), np.zeros(elements.max(initial=0) + 1, bool)
        cuts = np.flatnonzero(np.diff(a, prepend=-1))
        for begin, end in zip(cuts, [*cuts[1:], len(a)], strict=True):
            own = elements[starts[a[begin]] : starts[a[begin] + 1]]
            mark[own] = True
            for i in range(begin, end, _ROWS):
                of = b[i : min(i + _ROWS, end)]
                n = starts[of + 1] - starts[of]
                hits = np.concatenate([[0], np.cumsum(mark[elements[ranges(starts[of], starts[of + 1])]])])
                common[i : i + len(of)] = hits[np.cumsum(n)] - hits[np.cumsum(n) - n]
            mark[own] = False
        n, m = (starts[x + 1] - starts[x] for x in (a, b))
        similarity = common / np.maximum(n + m - common, 1)
        fit = similarity >= threshold
        return pa.table({"a": pairs["a"].to_numpy()[order][fit], "b": pairs["b"].to_numpy()[order][fit], "similarity": similarity[fit]})

    return confirm


def similar_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of all pairs of distinct sets (id, set) with a Jaccard similarity of at least ``threshold``; rows of equal sets count as one, under their least id.

    Elements are 64-bit hashes. Sorted from the rarest, two sets that similar share one of their first
    size - ceil(threshold * size) + 1 elements. The most frequent elements are numbered in that order, which the tasks
    know; the others come before them in the order of their hashes. So sets go whole through no shuffle to be sorted:
    what their prefixes hold is dealt to cells of elements and sizes, each set to a cell once, with a bitmap. There
    pairs are kept while sizes, places and bitmaps allow enough common elements: what these drop is under the threshold
    for certain. Whole sets meet only for the pairs left, those of one neighbourhood in one place.
    """
    hashed = written(sets.select(F.col("id").cast("bigint").alias("id"), F.array_distinct(F.transform("set", lambda e: F.xxhash64(e))).alias("set")).where("id is not null"), "hashed")
    counts = written(hashed.select(F.explode("set").alias("e")).groupBy("e").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    coded = written(hashed.mapInArrow(_coded(*_numbered(counts)), "id bigint, key bigint, rest array<bigint>, codes array<int>"), "coded")
    discard(hashed)
    discard(counts)
    rows = coded.count()
    cells = max(CELLS, rows // PER_CELL)
    held = coded.mapInArrow(_dealt(threshold, cells), "cell int, id bigint, key bigint, size int, bits binary, leading binary, elements array<int>, places array<int>")
    left = written(held.groupBy("cell").applyInArrow(_meet(threshold, cells), _PAIR).distinct(), "candidates")
    # Sets alike often have their least neighbour in common; a pair is compared there.
    of_a = left.groupBy("a", "key_a").agg(F.lit(None).cast("bigint").alias("least"))
    of_b = left.groupBy(F.col("b").alias("a"), F.col("key_b").alias("key_a")).agg(F.min("a").alias("least"))
    home = of_a.unionAll(of_b).groupBy("a", "key_a").agg(F.coalesce(F.min("least"), "a").alias("home"))
    pairs = written(left.join(home, ["a", "key_a"]).select(F.pmod(F.xxhash64("home"), F.lit(max(PARTS, rows // PER_PART))).alias("part"), *left.columns), "pairs")
    discard(left)
    end = lambda x: pairs.select(F.col("part").alias("place"), F.col(x).alias("id"), F.col(f"key_{x}").alias("key"))
    whole = coded.join(end("a").unionAll(end("b")).distinct(), ["id", "key"])
    return pairs.groupBy("part").cogroup(whole.groupBy("place")).applyInArrow(_confirmed(threshold), "a bigint, b bigint, similarity double")


def best_match(items: DataFrame, index: DataFrame, threshold: float = 0.54) -> DataFrame:
    """(item_id, entry_id, similarity): for each item (item_id, tokens) the most similar index entry, the first among equals.

    Only entries that share a token can score; the index side is blocked by token. A score of at least the threshold
    needs a containment of 0.35 or more of the smaller set, so no token may be left out of the blocks.
    """
    a = items.select("item_id", F.explode("tokens").alias("t"))
    b = index.select("entry_id", F.explode("tokens").alias("t"))
    both = a.join(b, "t").groupBy("item_id", "entry_id").agg(F.count("*").alias("both"))
    sized = both.join(items.select("item_id", F.size("tokens").alias("n")), "item_id").join(index.select("entry_id", F.size("tokens").alias("m")), "entry_id")
    score = F.floor((0.7 * F.col("both") / F.least("n", "m") + 0.3 * F.col("both") / (F.col("n") + F.col("m") - F.col("both"))) * 10_000 + 0.5) / 10_000
    best = sized.withColumn("similarity", score).where(F.col("similarity") >= threshold)
    top = best.groupBy("item_id").agg(F.max(F.struct("similarity", (-F.col("entry_id")).alias("entry"))).alias("m"))
    return top.select("item_id", (-F.col("m.entry")).alias("entry_id"), F.col("m.similarity").alias("similarity"))


def within_interval(df: DataFrame, key: str, id_col: str, ts: str, hours: float) -> DataFrame:
    """(a, b) of rows of one key at most ``hours`` apart, the smaller id first; rows meet in buckets of that length."""
    seconds = F.col(ts).cast("timestamp").cast("double")
    at = df.select(F.col(key).alias("key"), F.col(id_col).alias("id"), seconds.alias("s"), F.floor(seconds / (hours * 3600)).alias("bucket"))
    near = at.withColumn("bucket", F.explode(F.array(*(F.col("bucket") + i for i in (-1, 0, 1)))))
    a, b = at.alias("a"), near.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.bucket") == F.col("b.bucket")))
    return met.where((F.col("a.id") < F.col("b.id")) & (F.abs(F.col("a.s") - F.col("b.s")) <= hours * 3600)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def grouped(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """``nodes`` with the component of each; a node without edges is its own."""
    found = connected_components(edges).select(F.col("id").alias("_id"), "component")
    return nodes.join(found, nodes[id_col] == F.col("_id"), "left").drop("_id").withColumn("component", F.coalesce("component", id_col))
