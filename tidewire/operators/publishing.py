"""Snapshots that readers can trust: counted while they are written, published only if sound, rewritten by the day."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Rules = dict[str, tuple[str, Column]]


def article_rules(categories: list[str], forbidden: Column, proof: Column, least_chars: int = 300, least_ratio: float = 0.35) -> Rules:
    """What stored articles are held to, each with its severity: (id, category, url, url_status, content_status, body, ratio).

    ``forbidden``: the URL may not be one; ``proof``: what the text of a full article lacks for its category, an error
    for the project's and a warning for politics and economy.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    full, lacks = text("content_status") == "FULL_TEXT", F.coalesce(proof, F.lit("")) != ""
    return {
        "ID_MISSING": ("error", text("id") == ""),
        "CATEGORY_INVALID": ("error", ~text("category").isin(*categories)),
        "URL_FORBIDDEN": ("error", (text("url") != "") & forbidden),
        "URL_STATUS_WITHOUT_URL": ("error", text("url_status").isin("RECOVERED", "RESOLVED") & (text("url") == "")),
        "FULL_TEXT_TOO_SHORT": ("error", full & (F.length(text("body")) < least_chars)),
        "RATIO_TOO_LOW": ("error", full & (F.coalesce("ratio", F.lit(0.0)) < least_ratio)),
        "PROJECT_UNPROVEN": ("error", full & (F.col("category") == "bismayah") & lacks),
        "POLITICS_UNPROVEN": ("warning", full & (F.col("category") == "politics") & lacks),
        "ECONOMY_UNPROVEN": ("warning", full & (F.col("category") == "economy") & lacks),
    }


def write_counted(df: DataFrame, path: str, rules: Rules) -> dict[str, int]:
    """Write ``df`` and count, in the pass that writes, its rows and those that break each rule (a null verdict breaks it)."""
    seen = Observation()
    counts = [F.count_if(F.coalesce(bad, F.lit(True))).alias(name) for name, (_, bad) in rules.items()]
    df.observe(seen, F.count("*").alias("rows"), *counts).write.parquet(path)
    return {name: int(n or 0) for name, n in seen.get.items()}


def publish(df: DataFrame, folder: str, version: str, rules: Rules, id_col: str = "id") -> tuple[bool, dict[str, int]]:
    """Stage a snapshot, count what is wrong with it, and publish it beside the earlier versions only if no error was met.

    Repeated ids are counted over the staged ids, as they take an aggregation of their own. A batch with errors is
    removed and readers go on with the version before; a run that dies leaves a staged folder that no reader sees.
    """
    spark = df.sparkSession
    staged = f"{folder.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    counts = write_counted(df, staged, rules)
    repeated = spark.read.schema(df.schema).parquet(staged).where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1))
    counts["ID_REPEATED"] = int(repeated.first()[0] or 0)
    sound = not counts["ID_REPEATED"] and not any(counts[name] for name, (severity, _) in rules.items() if severity == "error")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    if not sound:
        system.delete(path(staged), True)
    elif not system.rename(path(staged), path(f"{folder.rstrip('/')}/version={version}")):
        raise FileExistsError(f"version {version} of {folder}")
    return sound, counts


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot of the greatest version that is published, by the folders' names; numbers in them compare as numbers."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path(folder))]
    natural = lambda name: [(1, int(x), "") if x.isdigit() else (0, 0, x) for x in re.findall("[0-9]+|[^0-9]+", name)]
    return spark.read.parquet(f"{folder.rstrip('/')}/{max((n for n in names if n.startswith('version=')), key=natural)}")


def rewrite_days(df: DataFrame, folder: str, day: str = "day") -> None:
    """Replace the days that ``df`` holds and no others; each day's rows are written by few tasks."""
    df.repartition(F.col(day), F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(folder)


def touched_days(changes: DataFrame, snapshot: DataFrame, key: str, day: str = "day") -> DataFrame:
    """The days of the snapshot that changes touch, as they must be: a changed key's row is replaced, new keys are added.

    A key keeps its day. Only the touched partitions of the snapshot are read: their list is a few days, known before.
    """
    days = [r[0] for r in changes.select(day).distinct().collect()]
    before = snapshot.where(F.col(day).isin(days)).join(changes.select(key, day), [key, day], "left_anti")
    return before.unionByName(changes.select(*before.columns))


def drop_days(spark: SparkSession, folder: str, before: date, day: str = "day") -> list[str]:
    """Delete the partitions of days before the given one, by their names: no row is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in system.listStatus(path(folder)) if s.getPath().getName().startswith(f"{day}=") and s.getPath().getName()[len(day) + 1 :] < before.isoformat()]
    for p in gone:
        system.delete(p, True)
    return sorted(p.getName() for p in gone)
