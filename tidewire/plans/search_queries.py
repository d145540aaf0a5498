"""Queries over groups of reports: search in all members, and groups that grow from run to run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import ids
from tidewire.operators import components, enrich, search, views
from tidewire.plans.registry import ARTICLES, Tables, query

_ASKED = ["Tion on", "keit", "la que", "of the, and", "ing. th", "***", "no such words here"]


@query(f"""SELECT q AS query, source AS "group", count(*) AS members FROM documents, (VALUES {", ".join(f"('{q.lower()}')" for q in _ASKED)}) t(q) WHERE contains(lower(text), q) GROUP BY ALL""")
def member_search(spark, d):
    """Sources with a document that holds what was asked, and how many of theirs do."""
    docs = Tables(spark, d).spread("documents").select("doc_id", "source", "text")
    found = search.search(search.build(docs, "doc_id"), docs, _ASKED, "doc_id")
    return search.groups(found, "source")


_LINKS = """links AS (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY left(text, 24)) AS b FROM documents UNION ALL SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, length(text)) FROM documents)"""


@query(f"""WITH RECURSIVE {_LINKS}, both_ways AS (SELECT DISTINCT a, b FROM links UNION SELECT b, a FROM links), walk AS (SELECT DISTINCT a, a AS b FROM links UNION SELECT w.a, e.b FROM walk w JOIN both_ways e ON w.b = e.a)
  SELECT a AS id, min(b) AS component FROM walk GROUP BY a""")
def components_by_day(spark, d):
    """Components of links that come on two days: the second day's links and the first day's labels give what all links would."""
    docs = Tables(spark, d).documents.select("doc_id", F.left("text", F.lit(24)).alias("opening"), "lang", F.length("text").alias("n"))
    least = lambda *keys: docs.join(docs.groupBy(*keys).agg(F.min("doc_id").alias("b")), [*keys]).select(F.col("doc_id").alias("a"), "b")
    first, second = least("opening"), least("lang", "n")
    labels = components.connected_components(first.where("a % 2 = 0"))
    return components.extended(labels, first.where("a % 2 = 1").unionByName(second))


_VIEWED = f"""(SELECT a.id, source AS component, category, body, CASE quality WHEN 1 THEN 'COMPLETED' WHEN 0 THEN 'FAILED' ELSE 'PENDING' END AS status, quality, toxic, length(body) % 101 AS score,
  CASE WHEN a.id % 5 > 0 THEN published_at END AS at_time, a.id % 7 <> 3 AS representative FROM {ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id)"""


@query(f"""WITH v AS (SELECT * FROM {_VIEWED} WHERE representative)
  SELECT 'ready' AS facet, id FROM v WHERE length(body) >= 300 AND status = 'COMPLETED' AND category = 'en' UNION ALL SELECT 'failed', id FROM v WHERE length(body) < 300
  UNION ALL SELECT 'selected', id FROM v WHERE toxic = 1 AND score >= 60 AND score < 70 UNION ALL SELECT 'period', id FROM v WHERE (at_time IS NULL OR (at_time >= TIMESTAMP '2024-01-01 02:00:00' AND at_time <= TIMESTAMP '2024-01-01 06:00:00')) AND status = 'PENDING'
  UNION ALL SELECT 'search', id FROM v WHERE component IN (SELECT source FROM documents WHERE contains(lower(text), 'stupid and')) AND category = 'fr'""")
def reader_views(spark, d):
    """What a reader's facets leave of the articles: ready and failed sources, picks by score, a period, a search in all members of a source."""
    t = Tables(spark, d)
    status = F.when(F.col("quality") == 1, "COMPLETED").when(F.col("quality") == 0, "failed")
    labels = t.labels.select(F.col("doc_id").alias("id"), "quality", "toxic")
    rows = t.articles().join(labels, "id", "left").select(
        "id", F.col("source").alias("component"), "category", F.col("body").alias("source_text"), status.alias("translation_status"), (F.length("body") % 101).alias("score"),
        F.when(F.col("id") % 5 > 0, F.col("published_at")).alias("published_at"), (F.col("id") % 7 != 3).alias("is_representative"),
    )
    at = lambda hour: F.lit(f"2024-01-01 {hour}:00:00").cast("timestamp")
    members = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("component"), "text")
    found = search.groups(search.search(search.build(members), members, ["stupid and"]))
    asked = {
        "ready": {"source": "ready", "translation": "COMPLETED", "category": "en"}, "failed": {"source": "failed"}, "selected": {"selected": labels.where("toxic = 1"), "bucket": "60-69"},
        "period": {"since": at("02"), "until": at("06"), "translation": "PENDING"}, "search": {"found": found, "category": "fr"},
    }
    out = None
    for name, facets in asked.items():
        one = views.reader_view(rows, **facets).select(F.lit(name).alias("facet"), "id")
        out = one if out is None else out.unionByName(one)
    return out


_COMPACT = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


@query(f"SELECT doc_id, sha256({_COMPACT.format('source')} || chr(10) || {_COMPACT.format('text')}) AS hash FROM documents")
def compact_hashes(spark, d):
    """Hashes of documents whose line ends and blanks don't count."""
    return Tables(spark, d).documents.select("doc_id", ids.content_hash(F.col("source"), F.col("text"), compact_body=True).alias("hash"))


_QUEUED = f"(SELECT a.id, length(body) AS n, quality, contains(body, 'ndly') AS direct, CASE WHEN contains(body, 'keit') THEN 98 ELSE 0 END AS floor FROM {ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id)"


@query(f"""SELECT id FROM {_QUEUED} WHERE n >= 300 AND NOT coalesce(quality = 1, false) ORDER BY n % 1000 DESC, id DESC LIMIT 200""")
def work_queue_order(spark, d):
    """The 200 documents whose derived content is made next."""
    return enrich.work_queue(_queued(spark, d), F.col("n") >= 300, F.col("quality") == 1, F.col("n") % 1000, F.col("id"), 200).select("id")


@query(f"""SELECT id, direct::INT * 1000000 + floor * 10000 + n % 100 * 100 AS priority FROM {_QUEUED} WHERE NOT coalesce(quality = 1, false) AND (direct OR n % 100 >= 60) ORDER BY priority DESC, id LIMIT 40""")
def model_candidates(spark, d):
    """The 40 documents worth a model's score, by their priority."""
    rows = _queued(spark, d)
    return enrich.candidates(rows, F.col("direct"), F.col("floor"), (F.col("n") % 100), F.col("quality") == 1).select("id", F.col("priority").cast("bigint").alias("priority"))


def _queued(spark, d):
    t = Tables(spark, d)
    a = t.articles().select("id", F.length("body").alias("n"), F.contains("body", F.lit("ndly")).alias("direct"), F.when(F.contains("body", F.lit("keit")), 98).otherwise(0).alias("floor"))
    return a.join(t.labels.select(F.col("doc_id").alias("id"), "quality"), "id", "left")


@query("""SELECT doc_id AS id, 'answer ' || doc_id AS answer, CASE WHEN doc_id % 3 < 2 THEN 'first' ELSE 'second' END AS provider, CASE WHEN doc_id % 3 = 1 THEN 2 ELSE 1 END AS attempt FROM documents WHERE doc_id % 3 < 2 OR doc_id % 5 > 0""")
def answers_with_fallback(spark, d):
    """A provider that answers two thirds of the documents in two tries, and one asked for the rest that fails on every fifth."""
    queue = Tables(spark, d).documents.select(F.col("doc_id").alias("id"))
    told = F.concat(F.lit("answer "), F.col("id").cast("string"))
    first = lambda rows, attempt: rows.select("id", F.when(F.col("id") % 3 == attempt - 1, told).alias("answer"))
    second = lambda rows, attempt: rows.where(F.col("id") % 5 > 0).select("id", told.alias("answer"))
    return enrich.answered(queue, {"first": first, "second": second}, "answer")
