"""Dedupe, top-k, balanced picks, ordered keepers: windows and sort keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row of each key, the first in the order; rows with a null key are dropped."""
    held = df.where(" and ".join(f"{k} is not null" for k in keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return held.withColumn("_place", place).where("_place = 1").drop("_place")


def keep_highest(df: DataFrame, keys: list[str], priority: str, pos: str) -> DataFrame:
    """The highest priority, the first among equals; ``first_pos`` is where the key first stood."""
    held = df.where(" and ".join(f"{k} is not null" for k in keys))
    # Combined before the shuffle, so a key of many rows brings one row of each task.
    best = F.min_by(F.struct(*df.columns), F.struct(F.col(priority).isNull(), -F.col(priority), F.col(pos)))
    return held.groupBy(*keys).agg(best.alias("_best"), F.min(pos).alias("first_pos")).select("_best.*", "first_pos")


def keep_last(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    return first_by(df, keys, F.col(pos).desc())


def keep_first(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    return first_by(df, keys, F.col(pos).asc())


def balanced_pick(df: DataFrame, bucket: str, order: list[Column], buckets: list[str], limit: int) -> DataFrame:
    """Round robin over the buckets in their given order, each in its own order, up to ``limit``.

    Each bucket gives at most ``limit`` rows, so the cut is made before the rows meet.
    """
    turn = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    rank = F.array_position(F.array(*map(F.lit, buckets)), F.col(bucket))
    turns = df.where(F.col(bucket).isin(buckets)).withColumn("turn", turn).where(F.col("turn") <= limit)
    return turns.withColumn("bucket_rank", rank.cast("int")).orderBy("turn", "bucket_rank").limit(limit)


def mandatory_then_balanced(df: DataFrame, mandatory: Column, bucket: str, order: list[Column], buckets: list[str], limit: int) -> DataFrame:
    """Mandatory rows first, by the order; what is left of the limit is picked in balance."""
    must = df.where(mandatory).orderBy(*order).limit(limit).withColumns({"turn": F.lit(0), "bucket_rank": F.lit(0)})
    rest = balanced_pick(df.where(~F.coalesce(mandatory, F.lit(False))), bucket, order, buckets, limit)
    return must.unionByName(rest).orderBy("turn", "bucket_rank", *order).limit(limit)


def newest_first(ts: Column, priority: Column, pos: Column) -> list[Column]:
    """Missing dates count as the epoch."""
    return [F.coalesce(ts, F.timestamp_seconds(F.lit(0))).desc(), priority.desc_nulls_last(), pos.asc()]


def by_importance(score: Column, ts: Column, ascending: bool = False) -> list[Column]:
    return [score.asc_nulls_last() if ascending else score.desc_nulls_last(), ts.desc_nulls_last()]


def by_time(ts: Column, title: Column, locale: str = "ar", oldest: bool = False) -> list[Column]:
    """The list of reports as readers order it: by time, those without one last and by title as the locale collates."""
    timed = ts.asc_nulls_last() if oldest else ts.desc_nulls_last()
    return [timed, F.when(ts.isNull(), F.collate(title, locale)).asc_nulls_last()]


def cluster_keepers(refs: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the references (section, item_index, cluster_id) one is kept for each cluster; the others are logged with a reason.

    A reference must name a known cluster and stand in one of its allowed sections; then the item with the fewest
    clusters wins, then the cluster's target section, then section order and place.
    """
    known = refs.join(clusters, "cluster_id", "left")
    size = F.count("*").over(Window.partitionBy("section", "item_index"))
    known = known.withColumn("cluster_count", size)
    fine = F.col("target_section").isNotNull() & F.array_contains("allowed_sections", F.col("section"))
    order = F.struct("cluster_count", (F.col("section") != F.col("target_section")).cast("int").alias("off_target"), "section", "item_index")
    place = F.row_number().over(Window.partitionBy("cluster_id", "fine").orderBy(order))
    judged = known.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("place", place)
    reason = (
        F.when(F.col("target_section").isNull(), "unknown-cluster")
        .when(~F.col("fine"), F.concat(F.lit("section-not-allowed:"), "section"))
        .when(F.col("place") > 1, "duplicate-reference")
    )
    judged = judged.withColumn("reason", reason)
    return judged.where("reason is null").select(refs.columns), judged.where("reason is not null").select(*refs.columns, "reason")
