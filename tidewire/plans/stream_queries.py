"""Queries over streams with state; the SQL gives what the stream must have told when its input is read to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.plans.registry import Tables, query
from tidewire.streaming.incremental import run_available
from tidewire.streaming.states import article_states, run_states

_LATE, _DAYS = 1, 1


@query(f"""WITH e AS (SELECT user_id AS key, ts AS seen_at, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS hash FROM events WHERE ts IS NOT NULL),
 seen AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seen_at, hash) AS n, lead(seen_at) OVER (PARTITION BY key ORDER BY seen_at, hash) AS next_at, coalesce(last_value(nullif(hash, '') IGNORE NULLS) OVER (PARTITION BY key ORDER BY seen_at, hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS known,
   coalesce(last_value(nullif(hash, '') IGNORE NULLS) OVER (PARTITION BY key ORDER BY seen_at, hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS now_known FROM e)
 SELECT key, seen_at, CASE WHEN n = 1 OR (hash <> '' AND known <> '' AND hash <> known) THEN 'PENDING' ELSE 'REUSED' END AS state,
   CASE WHEN n = 1 THEN 'new' WHEN hash = '' OR known = '' THEN 'unknown' WHEN hash = known THEN 'unchanged' ELSE 'changed' END AS reason, hash, known AS previous_hash FROM seen
 UNION ALL SELECT key, seen_at + INTERVAL {_DAYS} DAYS, 'PENDING', 'recheck', now_known, now_known FROM seen
 WHERE coalesce(next_at >= seen_at + INTERVAL {_DAYS} DAYS, seen_at + INTERVAL {_DAYS} DAYS <= (SELECT date_trunc('milliseconds', max(seen_at)) FROM e) - INTERVAL {_LATE} DAYS)""")
def stream_article_states(spark, d):
    """New, changed, unchanged and due versions of every user's events, their type as content; errors have none."""
    source = spark.readStream.schema(Tables(spark, d).events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    versions = source.withColumn("hash", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    return run_states(spark, lambda: run_available(article_states(versions, "user_id", "ts", "hash", _DAYS, f"{_LATE} day"), "states"))
