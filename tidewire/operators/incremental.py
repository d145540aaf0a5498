"""Runs against a previous snapshot: what is due, what carries over, what is kept, what is restored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.ranking import keep_last


def due_for_recheck(checked_at: Column, as_of: Column, days: int = 7, force: bool = False) -> Column:
    """Forced, never checked, or checked so many days ago."""
    return F.lit(force) | checked_at.isNull() | (checked_at <= as_of - F.expr(f"INTERVAL {days} DAYS"))


def pending(current: DataFrame, previous: DataFrame, key: str, complete: Column, due: Column) -> DataFrame:
    """Current rows without a complete row in the snapshot that isn't due; ``reason`` says whether they are new."""
    prev = previous.withColumn("_done", complete & ~due).groupBy(key).agg(F.max("_done").alias("_done"))
    joined = current.join(prev, key, "left")
    return joined.where(~F.coalesce("_done", F.lit(False))).withColumn("reason", F.when(F.col("_done").isNull(), "new").otherwise("recheck")).drop("_done")


def carry_over(current: DataFrame, previous: DataFrame, key: str, pos: str, hash_col: str, carried: list[str]) -> DataFrame:
    """Each current row with its state: new, reused (same hash: the carried columns come along), changed, or unknown.

    Of several previous rows of a key the last one counts; empty keys match nothing.
    """
    prev = keep_last(previous.where(F.col(key).cast("string") != ""), [key], pos)
    prev = prev.select(F.col(key).alias("_key"), F.col(hash_col).alias("previous_hash"), F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in carried))
    joined = current.join(prev, current[key] == F.col("_key"), "left")
    state = (
        F.when(F.col("_there").isNull(), "new")
        .when(F.coalesce("previous_hash", F.lit("")) == "", "unknown")
        .when(F.col("previous_hash") == F.col(hash_col), "reused")
        .otherwise("changed")
    )
    own = {c: (F.coalesce(F.col(c), F.col(f"_{c}")) if c in current.columns else F.col(f"_{c}")) for c in carried}
    kept = [F.when(F.col("state") == "reused", v).otherwise(F.col(c) if c in current.columns else F.lit(None)).alias(c) for c, v in own.items()]
    return joined.withColumn("state", state).select(*(c for c in current.columns if c not in carried), *kept, "state", "previous_hash")


def restore_base(base: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Base rows that are missing from the current ones, before those; ``restored`` tells them."""
    missing = base.join(current.select(key), key, "left_anti").withColumn("restored", F.lit(True))
    return missing.unionByName(current.withColumn("restored", F.lit(False)), allowMissingColumns=True)


def insert_missing(seeds: DataFrame, articles: DataFrame, seed_key: str, keys: list[str]) -> DataFrame:
    """Seeds that match no article by any of its keys; running it again inserts nothing."""
    known = articles.select(F.explode(F.array(*keys)).alias(seed_key)).where(F.col(seed_key).isNotNull() & (F.col(seed_key) != "")).distinct()
    return seeds.join(known, seed_key, "left_anti")


def coalesce_matches(rows: DataFrame, other: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``value`` of the other table by the first key that matches; of several rows of a key the greatest value counts."""
    out, found = rows, []
    for k in keys:
        side = other.where(F.col(k).isNotNull()).groupBy(k).agg(F.max(value).alias(f"_by_{k}"))
        out, found = out.join(side, k, "left"), [*found, F.col(f"_by_{k}")]
    return out.withColumn(value, F.coalesce(*found)).drop(*(f"_by_{k}" for k in keys))


def last_write_wins(latest: DataFrame, generated: DataFrame, key: str, ts: str) -> DataFrame:
    """The newer row of each key; a generated row of equal time wins."""
    both = latest.withColumn("_from", F.lit(0)).unionByName(generated.withColumn("_from", F.lit(1)))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col(ts).desc_nulls_last(), F.col("_from").desc()))
    return both.withColumn("_place", place).where("_place = 1").drop("_place", "_from")


def upsert(existing: DataFrame, candidates: DataFrame, url: str, title: str, order: list[Column]) -> DataFrame:
    """Candidates, one a URL and then one a title by the order (those without either stay apart), each with ``target``: the id it updates, null if it is new."""
    place = lambda c: F.row_number().over(Window.partitionBy(c).orderBy(*order))
    none = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    once = candidates.withColumn("_u", place(url)).where((F.col("_u") == 1) | none(url)).withColumn("_t", place(title)).where((F.col("_t") == 1) | none(title)).drop("_u", "_t")
    return coalesce_matches(once, existing.withColumnRenamed("id", "target"), [url, title], "target")


def day_in(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def in_rolling_days(ts: Column, end: Column, days: int, zone: str = "Asia/Seoul") -> Column:
    """The calendar day in the zone is one of the ``days`` up to ``end``; a missing or invalid date is outside."""
    day = day_in(ts, zone)
    return F.coalesce(day.between(F.date_sub(end, days - 1), end), F.lit(False))


def in_rolling_hours(raw: Column, ts: Column, as_of: Column, days: int) -> Column:
    """At most so many days old; an unreadable date stays, a missing one counts as the epoch and goes."""
    known = F.when(F.coalesce(raw, F.lit("")) == "", F.timestamp_seconds(F.lit(0))).otherwise(ts)
    return F.coalesce(known >= as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(True))


def is_current(status: Column, version: Column, wanted: str, source_hash: Column, now_hash: Column, signature: Column, now_signature: Column) -> Column:
    """Derived content still holds: completed, by this version, from this source, with these terms (none stored: tolerated)."""
    return F.coalesce((status == "COMPLETED") & (version == wanted) & (source_hash == now_hash) & (signature.isNull() | (signature == now_signature)), F.lit(False))


def reconcile(status: Column, current: Column) -> Column:
    """Completed but no longer current goes back to pending."""
    return F.when((status == "COMPLETED") & ~current, "PENDING").otherwise(status)
