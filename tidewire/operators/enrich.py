"""Derived content from outside models: work queues, provider tables, result checks. No provider is set by default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.lexicon import glossary_terms
from tidewire.functions.text import BLANKS
from tidewire.sources.shared_folder import discard, written

#: Takes the queued rows (id and inputs), gives rows of results by id; runs as a plan, so any source of results will do.
Provider = Callable[[DataFrame], DataFrame]


def work_queue(rows: DataFrame, usable: Column, current: Column, importance: Column, ts: Column, limit: int = 200) -> DataFrame:
    """Usable rows without current content, the most important and then the newest first; a limit of 0 takes all."""
    queue = rows.where(usable & ~F.coalesce(current, F.lit(False))).orderBy(importance.desc_nulls_last(), ts.desc_nulls_last())
    return queue.limit(limit) if limit else queue


def candidates(rows: DataFrame, direct: Column, floor: Column, rule: Column, cached: Column, limit: int = 40) -> DataFrame:
    """Rows worth a model's score: not cached, and direct or of rule score 60 or more, by direct, floor and rule score."""
    priority = direct.cast("int") * 1_000_000 + F.coalesce(floor, F.lit(0)) * 10_000 + rule * 100
    return rows.where(~F.coalesce(cached, F.lit(False)) & (direct | (rule >= 60))).withColumn("priority", priority).orderBy(F.col("priority").desc(), "id").limit(limit)


def model_input(title: Column, body: Column, most: int = 1_800) -> Column:
    """What a model is given of a row, as JSON."""
    squeeze = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BLANKS, " "))
    return F.to_json(F.struct(F.substring(squeeze(title), 1, 800).alias("title"), F.substring(squeeze(body), 1, most).alias("body")))


def report_source(rows: DataFrame, glossary: dict[str, list[str]]) -> DataFrame:
    """What a report's writer is given of each row: its fields compacted, and the glossary's terms in title and text."""
    squeeze = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BLANKS, " "))
    both = F.concat_ws("\n", "title", "text")
    return rows.select("id", F.lower("category").alias("category"), squeeze(F.col("source")).alias("source"), F.coalesce("url", F.lit("")).alias("url"), squeeze(F.col("title")).alias("title"), "text", glossary_terms(both, glossary).alias("terms"))


def enriched(rows: DataFrame, queue: DataFrame, provider: Provider | None, value: str, key: str = "id") -> DataFrame:
    """``rows`` with the provider's value for the queued ones; answers for ids that weren't asked are ignored."""
    if provider is None:
        return rows.withColumn(value, F.lit(None).cast("double"))
    found = provider(queue).join(queue.select(key), key, "left_semi").groupBy(key).agg(F.max(value).alias(value))
    return rows.join(found, key, "left")


def answered(queue: DataFrame, providers: dict[str, Callable[[DataFrame, int], DataFrame]], value: str, key: str = "id", tries: int = 2) -> DataFrame:
    """(key, value, provider, attempt) of all that got an answer: each provider is asked for what is missing, then the next one.

    A provider is a function of (rows still without an answer, attempt) and may answer some of them; an answer of null is
    none, and answers for keys that weren't asked are ignored. Each round is a table, so nothing is asked twice over.
    """
    left, done = written(queue, "queue"), []
    for name, provider in providers.items():
        for attempt in range(1, tries + 1):
            if left.isEmpty():
                break
            found = provider(left, attempt).where(F.col(value).isNotNull()).join(left.select(key), key, "left_semi").groupBy(key).agg(F.max(value).alias(value))
            done.append(written(found.select(key, value, F.lit(name).alias("provider"), F.lit(attempt).alias("attempt")), "answers"))
            rest = written(left.join(done[-1].select(key), key, "left_anti"), "queue")
            discard(left)
            left = rest
    if not done:
        return queue.select(key, F.lit(None).cast("string").alias(value), F.lit("").alias("provider"), F.lit(0).alias("attempt")).where("false")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every


def missing(queue: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """What a retry has to ask for again."""
    return queue.join(results.select(key), key, "left_anti")


def newest_current(latest: DataFrame, generated: DataFrame, key: str, source_hash: str, ts: str) -> DataFrame:
    """Generated rows that still fit the latest source, the newest of each key, with why the others go."""
    now = latest.select(key, F.col(source_hash).alias("_now"))
    joined = generated.join(now, key, "left").withColumn("reason", F.when(F.col("_now").isNull(), "UNKNOWN_ID").when(F.col("_now") != F.col(source_hash), "SOURCE_CHANGED"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(key, F.col("reason").isNull()).orderBy(F.col(ts).desc_nulls_last()))
    return joined.withColumn("_place", place).withColumn("reason", F.when(F.col("reason").isNull() & (F.col("_place") > 1), "OLDER").otherwise(F.col("reason"))).drop("_now", "_place")


def resolution(recovered_ok: Column, decoded_ok: Column, redirected_ok: Column, candidate_ok: Column) -> Column:
    """How a publisher's URL was found, over what was fetched: as recovered, decoded, redirected, from the page, or not."""
    return F.when(recovered_ok, "RECOVERED_URL").when(decoded_ok, "DECODED_REDIRECT").when(redirected_ok, "HTTP_REDIRECT").when(candidate_ok, "PAGE_METADATA").otherwise("FAILED")
