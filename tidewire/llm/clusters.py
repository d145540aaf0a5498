"""Clustering of vectors by centroids, with exact integers and bounds that spare most distances (Exponion search).

Every vector keeps an upper bound of the distance to its centroid and a lower bound of that to any other; both are
shifted by how far the centroids moved. While the upper one is under the lower one, or under half the distance between
its centroid and the next, no distance is taken. Otherwise the upper bound is made exact, and if that doesn't settle it,
only the centroids inside a ball around the current one are scanned: those within 2 * upper + (distance to the nearest
other centroid), its border included so that ties are seen. They are read off the current centroid's list of the others,
sorted by distance, in steps of powers of two. Distances are compared as integers; bounds are widened by more than
rounding can lose, so results are those of comparing all.

A round reads and writes one table of (id, integers, cluster, bounds); Spark sums the components of every cluster, and
the driver sees ``k`` rows of sums, never vectors.

Defined results: kept are vectors of exactly ``dims`` components, none of them null, NaN or infinite, nor of 2**27 or more
after scaling, where squared distances might not fit a long; others have no row. Start centroids are picked by the hash of
the id, a null id last, equal ids by their vectors; if fewer than ``k`` vectors are kept, each starts a cluster. Repeated
rows are vectors of their own. No kept vector: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import discard, written

LARGEST, SLACK = 1 << 27, 1e-9
#: Products of components up to this size sum exactly in double precision.
_EXACT = 1 << 22
STATE = "vec_id bigint, v array<int>, cluster int, upper double, lower double"


def integers(x: Column, scale: int) -> Column:
    return F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int"))


def usable(df: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the kept vectors as integers."""
    bad = F.exists(vec_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) >= LARGEST))
    kept = df.where((F.size(vec_col) == dims) & ~F.coalesce(bad, F.lit(True)))
    return kept.select(F.col(id_col).cast("bigint").alias("vec_id"), integers(F.col(vec_col), scale).alias("v"))


def squares(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 rows to int64 points."""
    if max(np.abs(x).max(initial=0), np.abs(points).max(initial=0)) <= _EXACT:
        cross = np.rint(x.astype(np.float64) @ points.T.astype(np.float64)).astype(np.int64)
    else:
        cross = x @ points.T
    return (x * x).sum(1)[:, None] - 2 * cross + (points * points).sum(1)


class Centroids:
    """The points, for each the others in order of distance, and how far each has moved since the bounds were taken."""

    def __init__(self, points: np.ndarray, before: np.ndarray | None = None):
        self.points, k = points, len(points)
        apart = np.sqrt(squares(points, points).astype(np.float64))
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.next = np.where(np.eye(k, dtype=bool), np.inf, apart).min(1)
        moved = np.zeros(k) if before is None else np.sqrt(((points - before) ** 2).sum(1).astype(np.float64))
        self.moved = moved
        self.others_moved = np.array([np.delete(moved, i).max(initial=0) for i in range(k)])

    def _settle(self, x: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, ...]:
        """The nearest of the candidates (ascending numbers), its squared distance, and bounds."""
        found = squares(x, self.points[candidates])
        best = found.argmin(1)
        rows = np.arange(len(x))
        least = found[rows, best]
        found[rows, best] = np.iinfo(np.int64).max
        second = np.sqrt(found.min(1).astype(np.float64)) if len(candidates) > 1 else np.full(len(x), np.inf)
        return candidates[best], least, np.sqrt(least.astype(np.float64)) * (1 + SLACK), second * (1 - SLACK)

    def first(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(cluster, upper, lower, squared distance) by comparing all."""
        cluster, least, upper, lower = self._settle(x, np.arange(len(self.points)))
        return cluster, upper, lower, least

    def again(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """(cluster, upper, lower, squared distance, distances taken) from the bounds of the round before."""
        cluster = cluster.copy()
        upper = (upper + self.moved[cluster]) * (1 + SLACK)
        lower = (lower - self.others_moved[cluster]) * (1 - SLACK) - SLACK
        enough = np.maximum(lower, self.next[cluster] / 2 * (1 - SLACK))
        own = ((x - self.points[cluster]) ** 2).sum(1)
        unsure = np.flatnonzero(upper >= enough)
        upper[unsure] = np.sqrt(own[unsure].astype(np.float64)) * (1 + SLACK)
        unsure = unsure[upper[unsure] >= enough[unsure]]
        taken = 0
        if len(unsure):
            at = cluster[unsure]
            radius = (2 * upper[unsure] + self.next[at]) * (1 + SLACK)
            inside = np.zeros(len(at), np.int64)
            for a in np.unique(at):
                inside[at == a] = np.searchsorted(self.apart[a], radius[at == a], "right")
            inside = np.minimum(1 << np.ceil(np.log2(np.maximum(inside, 1))).astype(int), len(self.points))
            for a, n in {*zip(at.tolist(), inside.tolist(), strict=True)}:
                of = unsure[(at == a) & (inside == n)]
                cluster[of], own[of], upper[of], lower[of] = self._settle(x[of], np.sort(self.order[a, :n]))
                taken += len(of) * int(n)
        return cluster, upper, lower, own, taken


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _assigned(rows: DataFrame, centroids: Centroids, dims: int, last: bool) -> DataFrame:
    """The rows with the cluster of this round; after the last one their distance in place of bounds and vector."""
    held, known = rows.sparkSession.sparkContext.broadcast(centroids), "cluster" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dims)
            if known:
                cluster, upper, lower, own, _ = held.value.again(x, *(batch.column(i).to_numpy() for i in (2, 3, 4)))
            else:
                cluster, upper, lower, own = held.value.first(x)
            cluster = pa.array(cluster, pa.int32())
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), cluster, pa.array(own, pa.int64())], ["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cluster, pa.array(upper), pa.array(lower)], ["vec_id", "v", "cluster", "upper", "lower"])

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint" if last else STATE)


def _moved(state: DataFrame, points: np.ndarray) -> np.ndarray:
    """Each centroid with vectors becomes the floor of their mean."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *(F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(points.shape[1])))
    new = points.copy()
    for r in sums.collect():
        new[r["cluster"]] = [s // r["n"] for s in r[2:]]
    return new


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, and the ``k`` final centroids) after ``rounds`` rounds and a last assignment."""
    spark = df.sparkSession
    rows = usable(df, dims, scale, id_col, vec_col)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = rows.orderBy(drawn.asc_nulls_last(), "v").limit(k).collect()
    if not start:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), np.zeros((0, dims), np.int64)
    centroids, state = Centroids(np.array([r["v"] for r in start], np.int64)), rows
    for _ in range(rounds):
        made = written(_assigned(state, centroids, dims, last=False), "clusters")
        if state is not rows:
            discard(state)
        state = made
        centroids = Centroids(_moved(state, centroids.points), centroids.points)
    final = written(_assigned(state, centroids, dims, last=True), "clustered")
    if state is not rows:
        discard(state)
    return final, centroids.points


def report(final: DataFrame, points: np.ndarray) -> DataFrame:
    """``cluster``'s rows with the inertia of their cluster and of all, and the hash of their centroid; sums beyond a long are its largest."""
    sums = dict(final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # a number for each of k
    most = 2**63 - 1
    every = int(min(sum(sums.values()), most))
    told = [(i, int(min(sums.get(i, 0), most)), every, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for i, p in enumerate(points.tolist())]
    known = final.sparkSession.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return final.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


#: ``report`` of ``cluster`` in DuckDB's SQL, comparing every vector with every centroid.
_ASSIGN = """a{n} AS (
  SELECT vec_id, v, (best).c AS c, (best).d AS d FROM (SELECT k.vec_id, k.v, list_min(list_transform(p.points, lambda c: {{'d': list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.p[i]) * (k.v[i] - c.p[i])))::BIGINT, 'c': c.c}})) AS best FROM kept k, p{n} p)
)"""
_MOVE = """p{n} AS (
  SELECT list({{'c': c, 'p': p}} ORDER BY c) AS points FROM (
    SELECT c.c, coalesce(m.p, c.p) AS p FROM (SELECT unnest(points) AS c FROM p{m}) t(c) LEFT JOIN (
      SELECT c AS at, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS p FROM (SELECT c, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{m}, range(1, 65) r(i) GROUP BY c, i) GROUP BY c) m ON m.at = c.c)
)"""
SQL = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), start AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept ORDER BY 1 LIMIT 16
), p0 AS (
  SELECT list({{'c': c, 'p': v}} ORDER BY c) AS points FROM start
), {", ".join(x for n in range(3) for x in (_ASSIGN.format(n=n), _MOVE.format(n=n + 1, m=n)))}, {_ASSIGN.format(n=3)}
SELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(t.c.p, ',')) AS centroid_sha256
FROM a3 a JOIN (SELECT unnest(points) AS c FROM p3) t ON t.c.c = a.c
"""
