"""Queries over snapshots: what a gate counts while a batch is written, and what days a run rewrites."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from tidewire.functions import text, urls
from tidewire.operators import publishing
from tidewire.plans.page_queries import _HOST
from tidewire.plans.registry import ARTICLES, Tables, query
from tidewire.sources.shared_folder import shared_folder

_CATEGORIES = {"en": "politics", "fr": "economy", "de": "bismayah"}
_LATIN = "length(regexp_replace(body, '[^a-z]', '', 'g'))::DOUBLE / greatest(length(regexp_replace(body, '[^\\p{L}\\p{N}]', '', 'g')), 1)"
_ROWS = f"""(SELECT CASE WHEN id % 97 <> 5 THEN id END AS id, CASE category WHEN 'en' THEN 'politics' WHEN 'fr' THEN 'economy' WHEN 'de' THEN 'bismayah' ELSE category END AS category, coalesce(p.url, '') AS url,
  CASE id % 3 WHEN 0 THEN 'RESOLVED' ELSE 'FAILED' END AS url_status, CASE id % 4 WHEN 0 THEN 'PENDING' ELSE 'FULL_TEXT' END AS content_status, body, floor({_LATIN} * 10000 + 0.5) / 10000 AS ratio,
  contains(body, 'tion') OR contains(body, 'keit') AS proven FROM {ARTICLES} a LEFT JOIN pages p ON p.page_id = a.id)"""
_CHECKS = {
    "ID_MISSING": ("error", "id IS NULL"), "CATEGORY_INVALID": ("error", "category NOT IN ('bismayah', 'politics', 'economy', 'security', 'international')"),
    "URL_FORBIDDEN": ("error", f"url <> '' AND ({_HOST.format('url')} = 'spam-farm.example.org' OR {_HOST.format('url')} LIKE '%.spam-farm.example.org')"), "URL_STATUS_WITHOUT_URL": ("error", "url_status = 'RESOLVED' AND url = ''"),
    "FULL_TEXT_TOO_SHORT": ("error", "content_status = 'FULL_TEXT' AND length(body) < 300"), "RATIO_TOO_LOW": ("error", "content_status = 'FULL_TEXT' AND ratio < 0.35"),
    "PROJECT_UNPROVEN": ("error", "content_status = 'FULL_TEXT' AND category = 'bismayah' AND NOT proven"), "POLITICS_UNPROVEN": ("warning", "content_status = 'FULL_TEXT' AND category = 'politics' AND NOT proven"),
    "ECONOMY_UNPROVEN": ("warning", "content_status = 'FULL_TEXT' AND category = 'economy' AND NOT proven"),
}


@query(" UNION ALL ".join([
    f"SELECT 'every' AS batch, 'rows' AS rule, '' AS severity, count(*) AS n, false AS published FROM {_ROWS}", *(f"SELECT 'every', '{r}', '{s}', count(*) FILTER ({bad}), false FROM {_ROWS}" for r, (s, bad) in _CHECKS.items()),
    "SELECT 'every', 'ID_REPEATED', 'error', 0, false", f"SELECT 'sound', 'rows', '', count(*), true FROM {_ROWS} WHERE NOT ({' OR '.join(f'({bad})' for s, bad in _CHECKS.values() if s == 'error')})",
    "SELECT 'read back', 'rows', '', count(*), true FROM " + _ROWS + f" WHERE NOT ({' OR '.join(f'({bad})' for s, bad in _CHECKS.values() if s == 'error')})"]))
def quality_gate(spark, d):
    """Articles made of the documents and the pages' URLs: what the gate counts, that it withholds them all, and publishes the sound ones."""
    t = Tables(spark, d)
    urls_of = t.pages.select(F.col("page_id").alias("id"), "url")
    rows = t.articles().join(urls_of, "id", "left").select(
        F.when(F.col("id") % 97 != 5, F.col("id")).alias("id"), F.coalesce(*(F.when(F.col("category") == k, v) for k, v in _CATEGORIES.items()), "category").alias("category"), F.coalesce("url", F.lit("")).alias("url"),
        F.when(F.col("id") % 3 == 0, "RESOLVED").otherwise("FAILED").alias("url_status"), F.when(F.col("id") % 4 == 0, "PENDING").otherwise("FULL_TEXT").alias("content_status"), "body",
        text.script_ratio(F.col("body"), "a-z").alias("ratio"),
    )
    lacks = F.when(~F.contains("body", F.lit("tion")) & ~F.contains("body", F.lit("keit")), "UNPROVEN")
    rules = publishing.article_rules(["bismayah", "politics", "economy", "security", "international"], urls.forbidden(F.col("url"), ["spam-farm.example.org"]), lacks)
    folder = f"{shared_folder(spark)}/tidewire/gate-{uuid.uuid4().hex}"
    done, counts = publishing.publish(rows, folder, "v1", rules)
    bad = F.lit(False)
    for severity, broken in rules.values():
        bad = bad | F.coalesce(broken, F.lit(True)) if severity == "error" else bad
    fine, sound = publishing.publish(rows.where(~bad), folder, "v2", rules)
    severity = {name: s for name, (s, _) in rules.items()} | {"rows": "", "ID_REPEATED": "error"}
    told = [("every", name, severity[name], n, done) for name, n in counts.items()] + [("sound", "rows", "", sound["rows"], fine)]
    schema = "batch string, rule string, severity string, n bigint, published boolean"
    back = publishing.published(spark, folder).agg(F.count("*").alias("n")).select(F.lit("read back").alias("batch"), F.lit("rows").alias("rule"), F.lit("").alias("severity"), "n", F.lit(True).alias("published"))
    return spark.createDataFrame(told, schema).unionByName(back)


@query("""WITH days AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, value FROM events WHERE ts IS NOT NULL),
  changed AS (SELECT event_id, user_id, day, value * 2 AS value FROM days WHERE day IN (DATE '2024-01-10', DATE '2024-01-20') AND event_id % 3 = 0)
  SELECT event_id, user_id, day, value FROM days WHERE day >= DATE '2024-01-05' AND event_id NOT IN (SELECT event_id FROM changed) UNION ALL SELECT event_id, user_id, day, value FROM changed""")
def snapshot_days(spark, d):
    """A snapshot of the events by the day: changes of two days rewrite those, and days before the fifth are dropped unread."""
    folder = f"{shared_folder(spark)}/tidewire/days-{uuid.uuid4().hex}"
    rows = Tables(spark, d).events.where("ts is not null").select("event_id", "user_id", F.to_date("ts").alias("day"), "value")
    publishing.rewrite_days(rows, folder)
    snapshot = spark.read.schema(rows.schema).parquet(folder)
    changes = rows.where("day in (date'2024-01-10', date'2024-01-20') and event_id % 3 = 0").withColumn("value", F.col("value") * 2)
    publishing.rewrite_days(publishing.touched_days(changes, snapshot, "event_id"), folder)
    publishing.drop_days(spark, folder, date(2024, 1, 5))
    return spark.read.schema(rows.schema).parquet(folder).select("event_id", "user_id", "day", "value")
