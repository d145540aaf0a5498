"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import discard, written


def _towards_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link what surrounds each node ``u`` to the least node of it: only its larger neighbours, or only the smaller ones and ``u``."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if larger_only else both.where("v < u")
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    linked = around.join(least, "u")
    if larger_only:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    return linked.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).unionAll(least.select("u", F.col("least").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the least id reachable, for every id on an edge.

    Each round is a star of larger and one of smaller neighbours, each a table in the shared folder, so that plans stay
    small; a table is deleted when the next one is there. Rounds grow with the logarithm of the longest path. Loops and
    repeated edges do no harm; edges with a null end are ignored.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    loops, last, stars, before = edges.where("u = v").select(F.col("u").alias("id"), F.col("v").alias("component")), None, edges.where("u <> v"), None
    while True:
        larger = written(_towards_least(stars, True), "stars")
        if before is not None:
            discard(before)
        stars = before = written(_towards_least(larger, False), "stars")
        discard(larger)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    found = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionAll(found.select(F.col("component").alias("id"), "component")).unionAll(loops).groupBy("id").agg(F.min("component").alias("component"))


def extended(labels: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) after new edges came to a graph of which only the labels are kept.

    Every old component is contracted to its label: components are computed over the new edges between labels, and the
    labels that moved are replaced. Equal to a run over all edges, without the old ones; ids that no edge ever named
    need no row before they meet one.
    """
    known = labels.select(F.col("id"), "component")
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    of = lambda x: known.select(F.col("id").alias(x), F.col("component").alias(f"_{x}"))
    contracted = ends.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    moved = written(connected_components(contracted).select(F.col("id").alias("component"), F.col("component").alias("_to")), "moved")
    old = known.join(moved, "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    # Ends that had no label are their own label in the contracted graph.
    fresh = moved.select(F.col("component").alias("id"), F.col("_to").alias("component")).join(known.select("id"), "id", "left_anti")
    return old.unionByName(fresh)
