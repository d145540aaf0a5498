"""Nearest neighbours: an inverted file of coarse centroids, product-quantised residuals, asymmetric tables, exact reranking, exact check.

The centroids and the codebooks are fitted on at most ``SAMPLE_ROWS`` vectors; every vector is indexed: it goes to its
nearest centroid's cell, its residual to ``PARTS`` codes. A query reads its nearest cells: as many as trials within the
sample show to be needed, and more until they hold enough candidates. Only codes are searched: cells are dealt to tasks
in blocks of rows against blocks of queries, so neither a crowded cell nor one that many queries read is held by one
task, and a task returns for each query the ``SHORTLIST`` rows nearest by the distance tables. The nearest
``SHORTLIST`` of all blocks are a query's shortlist; only their vectors are fetched, by row, for the exact distance.

Codes tell rows apart only as far as the books, made for the whole table, do: of a dense lump among scattered rows all
have one code. So a check follows: the distance of a query's last neighbour bounds what could still be nearer. By the
triangle inequality that is in cells whose radius reaches so far, and there among rows whose distance to the centroid
is within the bound of the query's own; only those are compared, and the nearest of them are the result. It is exact.

Nearness is the Euclidean distance in double precision; ties go to the smaller id, in the shortlist too: equal vectors
have equal codes. Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite parts take no part, neither as queries nor as candidates; rows with a null id take no part; every row is a
candidate and, by its id, a query of its own, also where ids repeat, and is no neighbour of itself only; without two
vectors the result is empty. Measured recall at 10 against brute force is in the README.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import written

SAMPLE_ROWS, MAX_CELLS, PARTS, CODES, LEAST_PROBES, SHORTLIST = 32_768, 1_024, 16, 256, 16, 256
#: Queries of the sample that set the number of probes, and the share of their true neighbours that the cells must hold.
TRIALS, HELD = 256, 0.97
ROWS_IN_BLOCK, QUERIES_IN_BLOCK, QUERIES_IN_CHECK = 16_384, 1_024, 4_096
#: Relative room for rounding where rows are ruled out by distances that are not added up in the order of the score.
ROOM = 1e-11


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """At most ``k`` centres of the rows; a centre that loses its rows moves to a random row."""
    draw = np.random.default_rng(seed)
    rows = np.unique(x, axis=0)
    centres = rows[draw.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[draw.integers(0, len(x), len(centres))])
    return centres


@dataclass
class Index:
    centres: np.ndarray
    bounds: list[int]  # where the parts of a vector begin, and its length
    books: list[np.ndarray]
    probes: int = LEAST_PROBES

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int) -> Index:
        """``rows``: of the whole table, for the number of cells."""
        centres = k_means(sample, int(np.clip(np.sqrt(rows), 1, min(MAX_CELLS, max(1, len(sample) // 8)))))
        rest = sample - centres[_nearest(sample, centres)]
        parts = min(PARTS, sample.shape[1])
        bounds = [round(i * sample.shape[1] / parts) for i in range(parts + 1)]
        books = [k_means(rest[:, a:b], CODES, 6, i) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
        return cls(centres, bounds, books, max(LEAST_PROBES, cls.needed(sample, centres)))

    @staticmethod
    def needed(sample: np.ndarray, centres: np.ndarray, k: int = 10) -> int:
        """Nearest cells that hold the share ``HELD`` of the neighbours, within the sample, of some of its rows."""
        cells, trial = _nearest(sample, centres), sample[:TRIALS]
        far = _squares(trial, sample)
        far[np.arange(len(trial)), np.arange(len(trial))] = np.inf
        near = np.argpartition(far, k, axis=1)[:, :k] if len(sample) > k else np.argsort(far, axis=1)
        place = _squares(trial, centres).argsort(1).argsort(1)
        return int(np.quantile(np.take_along_axis(place, cells[near], 1), HELD)) + 1

    def codes(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        rest = x - self.centres[cells]
        return np.stack([_nearest(rest[:, a:b], book) for a, b, book in zip(self.bounds, self.bounds[1:], self.books, strict=False)], 1).astype(np.uint8)

    def table_distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the decoded rows of a cell, from one table a query and part."""
        rest, total = queries - self.centres[cell], np.zeros((len(queries), len(codes)), np.float32)
        for i, (a, b, book) in enumerate(zip(self.bounds, self.bounds[1:], self.books, strict=False)):
            total += _squares(rest[:, a:b], book).astype(np.float32)[:, codes[:, i]]
        return total


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to rows or to one, part by part as the score adds them up."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += (x[:, i] - y[:, i]) ** 2
    return np.sqrt(total)


def _nearer(rest: np.ndarray, away: np.ndarray, queries: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each query, the rows of a cell, in order of ``away``, that may be within its reach; all relative to the centroid."""
    far, size = _distances(queries, np.zeros((1, queries.shape[1]))), away * away
    room = ROOM * (far + reach + (away[-1] if len(away) else 0))
    first, end = np.searchsorted(away, far - reach - room), np.searchsorted(away, far + reach + room, "right")
    for q in range(len(queries)):
        a, b = (first[q], end[q]) if np.isfinite(reach[q]) else (0, len(away))
        if a < b:
            sum_of = size[a:b] + far[q] ** 2
            yield q, a + np.flatnonzero(~(sum_of - 2 * (rest[a:b] @ queries[q]) - ROOM * sum_of > reach[q] ** 2 * (1 + ROOM)))


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))


def neighbours(df: DataFrame, is_query: Callable[[Column], Column], k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each row for which ``is_query(vec_id)`` holds."""
    spark = df.sparkSession
    rows = _usable(df, id_col, vec_col)
    lengths = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not lengths or not lengths[0]["dims"]:
        return spark.createDataFrame([], schema)
    dims, total = lengths[0]
    rows = rows.where(F.size("vec") == dims)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toArrow()
    index = Index.fit(_matrix(sample["vec"].combine_chunks(), dims), total)
    held = spark.sparkContext.broadcast(index)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            cells = _nearest(x, held.value.centres)
            codes, away = held.value.codes(x, cells), _distances(x, held.value.centres[cells])
            columns = [*batch.columns, pa.array(cells, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(away, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vec", "row", "cell", "codes", "away"])

    numbered = rows.select("vec_id", "vec", F.monotonically_increasing_id().alias("row"))
    indexed = written(numbered.mapInArrow(put, "vec_id bigint, vec array<double>, row bigint, cell int, codes binary, away double"), "indexed")
    # Two numbers a cell, of MAX_CELLS at most. Cells go to groups of about ROWS_IN_BLOCK rows, a crowded one to several.
    filled, radius = np.zeros(len(index.centres), np.int64), np.zeros(len(index.centres))
    for r in indexed.groupBy("cell").agg(F.count("*").alias("rows"), F.max("away").alias("radius")).collect():
        filled[r["cell"]], radius[r["cell"]] = r["rows"], r["radius"]
    group = ((np.cumsum(filled) - filled) // ROWS_IN_BLOCK).astype(int)
    parts = np.maximum(-(-filled // ROWS_IN_BLOCK), 1).astype(int)
    placed = F.broadcast(spark.createDataFrame([(c, int(group[c]), int(parts[c])) for c in range(len(filled))], "cell int, group int, parts int"))

    def dealt(batch: pa.RecordBatch, picked: list[np.ndarray]) -> pa.RecordBatch:
        """A row for each query and group that holds some of the cells picked for it."""
        at, cells = [], []
        for i, near in enumerate(picked):
            near = near[filled[near] > 0]
            for g in np.unique(group[near]):
                at.append(i)
                cells.append(near[group[near] == g].astype(np.int32))
        taken = batch.take(pa.array(at, pa.int64()))
        more = [pa.array(cells, pa.list_(pa.int32())), pa.array([group[c[0]] for c in cells], pa.int32()), pa.array([parts[c].max() for c in cells], pa.int32())]
        return pa.RecordBatch.from_arrays([*taken.columns, *more], [*batch.schema.names, "cells", "group", "parts"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = []
            for q in _matrix(batch.column(1), dims):
                order = np.argsort(_squares(q[None], held.value.centres)[0], kind="stable")
                enough = int(np.searchsorted(np.cumsum(filled[order]), SHORTLIST + 1)) + 1
                picked.append(order[: max(probes or held.value.probes, enough)])
            yield dealt(batch, picked)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = []
            for q, reach in zip(_matrix(batch.column(1), dims), batch.column(2).to_numpy(), strict=True):
                far = _distances(held.value.centres, q[None])
                picked.append(np.flatnonzero(~(far - radius > reach + ROOM * (far + radius + reach))))
            yield dealt(batch, picked)

    queries = indexed.where(is_query(F.col("vec_id")))
    asked = written(queries.select(F.col("row").alias("query_row"), F.col("vec").alias("query")).mapInArrow(probe, "query_row bigint, query array<double>, cells array<int>, group int, parts int"), "asked")
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["group", "r", "q"]

    def met(asked: DataFrame, most: int, of_row: list[str], of_query: list[str]):
        """Rows and queries by group, in blocks of about ROWS_IN_BLOCK rows and ``most`` queries."""
        in_group = asked.groupBy("group").agg(F.ceil(F.count("*") / most).cast("int").alias("n_query"))
        left = indexed.join(placed, "cell").withColumn("r", own("row", "parts")).join(F.broadcast(in_group), "group").withColumn("q", each("n_query"))
        right = asked.join(F.broadcast(in_group), "group").withColumn("q", own("query_row", "n_query")).withColumn("r", each("parts"))
        left, right = left.select(*(F.col(c).alias(c) for c in (*keys, *of_row))), right.select(*(F.col(c).alias(c) for c in (*keys, *of_query)))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys))

    def search(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            ids, row, cell = (rows[c].to_numpy() for c in ("vec_id", "row", "cell"))
            order = np.lexsort((row, ids, cell))
            ids, row, cell = ids[order], row[order], cell[order]
            codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(len(ids), -1)[order]
            asking, wanted = queries["query_row"].to_numpy(), [set(c) for c in queries["cells"].to_pylist()]
            x = _matrix(queries["query"].combine_chunks(), dims)
            near = [[] for _ in asking]
            for c in np.unique(cell):
                a, b = np.searchsorted(cell, [c, c + 1])
                of = np.flatnonzero([c in w for w in wanted])
                for i in range(0, len(of), 64):
                    rough = held.value.table_distances(x[of[i : i + 64]], c, codes[a:b])
                    for q, distances in zip(of[i : i + 64], rough, strict=True):
                        near[q].append((a, distances))
            for q, found in enumerate(near):
                if found:
                    rough = np.concatenate([d for _, d in found])
                    at = np.concatenate([np.arange(a, a + len(d)) for a, d in found])
                    if len(rough) > SHORTLIST + 1:
                        kept = rough <= np.partition(rough, SHORTLIST)[SHORTLIST]
                        rough, at = rough[kept], at[kept]
                    other = row[at] != asking[q]
                    rough, at = rough[other], at[other]
                    best = np.lexsort((row[at], ids[at], rough))[:SHORTLIST]
                    out.append((np.full(len(best), asking[q]), row[at[best]], ids[at[best]], rough[best].astype(np.float64)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_row", "row", "vec_id", "rough"])

    found = met(asked, QUERIES_IN_BLOCK, ["cell", "vec_id", "row", "codes"], ["query_row", "query", "cells"]).applyInArrow(search, "query_row bigint, row bigint, vec_id bigint, rough double")
    place = lambda *order: F.row_number().over(Window.partitionBy("query_row").orderBy(*order))
    short = found.withColumn("place", place("rough", "vec_id", "row")).where(F.col("place") <= SHORTLIST).select("query_row", "row", "vec_id")
    vectors = indexed.select("row", "vec")
    asking = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("vec").alias("query"))
    exact = F.sqrt(F.aggregate(F.zip_with("vec", "query", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x))
    scored = short.join(vectors, "row").join(asking, "query_row").select("query_row", "row", "vec_id", exact.alias("score"))
    last = scored.withColumn("rank", place("score", "vec_id", "row")).where(F.col("rank") == k).select("query_row", F.col("score").alias("reach"))
    bounded = asking.drop("query_id").join(last, "query_row", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    checked = written(bounded.mapInArrow(reached, "query_row bigint, query array<double>, reach double, cells array<int>, group int, parts int"), "checked")

    def check(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            ids, row, cell, away = (rows[c].to_numpy() for c in ("vec_id", "row", "cell", "away"))
            order = np.lexsort((away, cell))
            ids, row, cell, away, vec = ids[order], row[order], cell[order], away[order], _matrix(rows["vec"].combine_chunks(), dims)[order]
            asking, reach, x = queries["query_row"].to_numpy(), queries["reach"].to_numpy(), _matrix(queries["query"].combine_chunks(), dims)
            cells = queries["cells"].combine_chunks()
            wanted, by = cells.flatten().to_numpy(), np.repeat(np.arange(len(x)), cells.value_lengths().to_numpy())
            order = np.argsort(wanted, kind="stable")
            wanted, by = wanted[order], by[order]
            for c in np.unique(cell):
                (a, b), of = np.searchsorted(cell, [c, c + 1]), by[slice(*np.searchsorted(wanted, [c, c + 1]))]
                centre = held.value.centres[c]
                for q, at in _nearer(vec[a:b] - centre, away[a:b], x[of] - centre, reach[of]):
                    at = a + at[row[a + at] != asking[of[q]]]
                    score = _distances(vec[at], x[of[q]][None])
                    best = np.lexsort((row[at], ids[at], score))[:k]
                    out.append((np.full(len(best), asking[of[q]]), row[at[best]], ids[at[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_row", "row", "vec_id", "score"])

    nearest = met(checked, QUERIES_IN_CHECK, ["cell", "vec_id", "row", "away", "vec"], ["query_row", "query", "reach", "cells"]).applyInArrow(check, "query_row bigint, row bigint, vec_id bigint, score double")
    ranked = nearest.withColumn("rank", place("score", "vec_id", "row")).where(F.col("rank") <= k)
    return ranked.join(asking.select("query_row", "query_id"), "query_row").select("query_id", "rank", "vec_id", "score")
