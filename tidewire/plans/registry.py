"""Named queries: a DataFrame plan each, and the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a plan under its function's name."""

    def add(plan):
        PLANS[plan.__name__] = plan
        if sql:
            SQL[plan.__name__] = sql
        return plan

    return add


class Tables:
    """The tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table whose rows cost much work: dealt to all tasks where its files can't be split among them."""
        df, tasks = getattr(self, name), self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)

    def articles(self) -> DataFrame:
        """Documents as articles: the title is the text up to the first stop or line end, a minute lies between two."""
        return self.spread("documents").select(
            F.col("doc_id").alias("id"),
            F.trim(F.regexp_extract("text", "^[^.\\n]*", 0)).alias("title"),
            F.col("text").alias("body"),
            F.substring("text", 1, 1400).alias("lead"),
            F.col("lang").alias("category"),
            "source",
            F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("published_at"),
        )


#: The same rows in SQL.
ARTICLES = """(SELECT doc_id AS id, trim(regexp_extract(text, '^[^.\\n]*')) AS title, text AS body, left(text, 1400) AS lead,
  lang AS category, source, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS published_at FROM documents)"""
