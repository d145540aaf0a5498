"""The reader's view: representatives, filters, facets, exports; and data quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCORES = (("90+", 90, 101), ("80-89", 80, 90), ("70-79", 70, 80), ("60-69", 60, 70), ("0-59", 0, 60))


def representatives(df: DataFrame, flag: str = "is_representative") -> DataFrame:
    return df.where(F.coalesce(flag, F.lit(True)))


def score_bucket(score: Column) -> Column:
    out = F.when(score.isNull(), "pending")
    for name, low, high in SCORES:
        out = out.when((score >= low) & (score < high), name)
    return out


def filtered(df: DataFrame, category: str | None = None, bucket: str | None = None, words: str | None = None, text: str = "text", since: Column | None = None, ts: str = "published_at") -> DataFrame:
    """Rows that meet every facet given; words are looked for without case."""
    for given, condition in ((category, F.col("category") == category), (bucket, score_bucket(F.col("score")) == bucket), (words, F.contains(F.lower(text), F.lit((words or "").lower())))):
        if given is not None:
            df = df.where(condition)
    return df if since is None else df.where(F.col(ts) >= since)


def reader_view(
    df: DataFrame, category: str | None = None, selected: DataFrame | None = None, source: str | None = None, translation: str | None = None, bucket: str | None = None,
    since: Column | None = None, until: Column | None = None, found: DataFrame | None = None, least_source: int = 300,
) -> DataFrame:
    """The representatives that a reader's facets leave: (id, component, category, source_text, translation_status, score, published_at).

    ``selected``: (id) of the reader's own picks; ``source``: "ready" or "failed" by the length of the source text;
    ``found``: (group) that the search in all members left (``search.groups``); a report without a date is in any period.
    """
    chars = F.length(F.coalesce("source_text", F.lit("")))
    facets = (
        (category, F.lower(F.coalesce("category", F.lit(""))) == category), (bucket, score_bucket(F.col("score")) == bucket), (translation, F.coalesce(F.upper("translation_status"), F.lit("PENDING")) == translation),
        (source, (chars >= least_source) if source == "ready" else (chars < least_source)),
    )
    shown = representatives(df) if "is_representative" in df.columns else df
    for given, condition in facets:
        shown = shown if given is None else shown.where(condition)
    for bound, inside in ((since, lambda b: F.col("published_at") >= b), (until, lambda b: F.col("published_at") <= b)):
        shown = shown if bound is None else shown.where(F.col("published_at").isNull() | inside(bound))
    if selected is not None:
        shown = shown.join(selected.select("id").distinct(), "id", "left_semi")
    if found is not None:
        shown = shown.join(found.select(F.col("group").alias("component")).distinct(), "component", "left_semi")
    return shown


def facet_counts(df: DataFrame, *facets: str) -> DataFrame:
    """Counts by each facet and in total, from one pass."""
    sets = F.grouping_id().alias("level")
    return df.cube(*facets).agg(F.count("*").alias("n"), sets) if len(facets) == 1 else df.rollup(*facets).agg(F.count("*").alias("n"), sets)


def related(df: DataFrame, group: str = "component", id_col: str = "id", ts: str = "published_at", most: int = 50) -> DataFrame:
    """Each row with the newest ``most`` other members of its group, the newest first: what a page of related reports shows."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col(ts).desc_nulls_last(), F.col(id_col).desc()))
    newest = df.withColumn("_place", place).where(F.col("_place") <= most + 1).groupBy(F.col(group).alias("_group"))
    listed = newest.agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", id_col))), lambda m: m[id_col]).alias("_newest"))
    joined = df.join(listed, df[group] == F.col("_group"), "left")
    return joined.withColumn("related", F.slice(F.array_remove("_newest", F.col(id_col)), 1, most)).drop("_group", "_newest")


def violations(df: DataFrame, id_col: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(rule, severity, id) of every row that breaks a rule, from one pass over the rows."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))) for name, (severity, bad) in rules.items())))
    return df.select(F.col(id_col).cast("string").alias("id"), F.explode(broken).alias("v")).select("v.rule", "v.severity", "id")


def repeated_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.groupBy(F.col(id_col).cast("string").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("REPEATED_ID").alias("rule"), F.lit("error").alias("severity"), "id")
