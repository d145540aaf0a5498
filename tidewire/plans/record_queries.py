"""Rules over stored records, indexes and files, over fixed rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewire.functions import ids, text, urls
from tidewire.operators import arabic_rules, discovery, enrich, events, incremental, ranking, records, rules, views
from tidewire.plans.fixed import copied, dealt, per_copy, per_document
from tidewire.plans.fixed import values as fixed
from tidewire.plans.page_queries import _CANONICAL
from tidewire.plans.registry import ARTICLES, Tables, query
from tidewire.sources import html, payloads
from tidewire.sources.shared_folder import shared_folder

NOW = lambda: F.lit("2026-08-04 00:00:00").cast("timestamp")
_TS = lambda c: F.try_to_timestamp(F.col(c))

_BLENDS = [
    ("both", 60, 80, "NORMAL", 0, "NONE", 0, None, 73, 0, "NONE", "MEDIUM", "NORMAL", 0.35), ("rule only", 60, None, None, 0, "NONE", 0, None, 60, 0, "NONE", "MEDIUM", "DEFAULT", 1.0),
    ("floor", 20, 30, "NORMAL", 95, "B", 72, "C", 95, 95, "B", "DIRECT", "MUST_INCLUDE", 0.35), ("tie", 10, None, None, 78, "B", 78, "C", 78, 78, "B", "HIGH", "REVIEW", 1.0),
    ("category", 10, None, None, 65, "B", 72, "C", 72, 72, "C", "HIGH", "REVIEW", 1.0), ("above", 90, 100, None, 80, "B", 0, None, 97, 80, "B", "DIRECT", "DEFAULT", 0.35), ("over", 0, 250, None, 0, "NONE", 0, None, 65, 0, "NONE", "MEDIUM", "DEFAULT", 0.35),
]


@query(per_document("id VARCHAR, score INT, floor INT, floor_rule VARCHAR, relevance VARCHAR, priority VARCHAR, rule_weight DOUBLE", [(r[0], *r[8:]) for r in _BLENDS]))
def importance_outcome(spark, d):
    rows = dealt(spark, d, [r[:8] for r in _BLENDS], "id string, rule int, model int, model_priority string, b int, b_rule string, c int, c_rule string")
    floor = lambda x: F.struct(F.col(x).alias("score"), F.col(f"{x}_rule").alias("rule"))
    made = records.outcome(F.col("rule"), F.col("model"), F.col("model_priority"), floor("b"), floor("c"), F.lit("DEFAULT"))
    return rows.select("doc_id", "id", made.alias("o")).select("doc_id", "id", "o.*")


_STORED = [("first", "71.5", "10", 72), ("second", None, "33", 33), ("high", "140", None, 100), ("low", "-3", None, 0), ("text", "many", "50", None), ("none", None, None, None), ("nan", "NaN", None, None)]


@query(per_document("id VARCHAR, score INT, bucket VARCHAR", [(r[0], r[3], {72: "70-79", 33: "0-59", 100: "90+", 0: "0-59", None: "pending"}[r[3]]) for r in _STORED]))
def stored_scores(spark, d):
    rows = dealt(spark, d, [r[:3] for r in _STORED], "id string, a string, b string").select("doc_id", "id", records.stored_score(F.col("a"), F.col("b")).alias("score"))
    return rows.withColumn("bucket", views.score_bucket(F.col("score")))


_LONG = "가" * 50
_ARTICLES = [
    ("r1", "COMPLETED", "제목", _LONG, "x" * 300, None, "economy", "2026-08-01T00:00:00Z"), ("r2", "completed", "제목", _LONG, "x" * 299, None, "politics", "2026-08-02T00:00:00Z"),
    ("r3", "PENDING", "제목", _LONG, "x" * 300, None, "politics", "2026-08-02T00:00:00Z"), ("r4", "COMPLETED", " ", _LONG, "x" * 300, True, "politics", "2026-08-02T00:00:00Z"),
    ("r5", "COMPLETED", "제목", _LONG[1:], "x" * 300, True, "politics", "2026-08-02T00:00:00Z"), ("r6", "COMPLETED", "제목", _LONG, "x" * 300, False, "politics", "2026-08-02T00:00:00Z"),
    ("r7", "COMPLETED", "제목", _LONG, "x" * 300, True, "bismayah", "2026-08-03T20:00:00Z"), ("", "COMPLETED", "제목", _LONG, "x" * 300, True, "security", None),
]


_ARTICLE = "id string, status string, title string, text string, source_text string, is_representative boolean, category string, stamp string"


def _articles(spark):
    return _readiness(spark.createDataFrame(_ARTICLES, _ARTICLE))


def _readiness(rows):
    rows = rows.withColumn("ready", records.ready(F.col("status"), F.col("title"), F.col("text"))).withColumn("published_at", _TS("stamp"))
    return rows.withColumn("exportable", records.exportable(F.col("ready"), F.col("source_text"), F.col("id")))


@query(per_document("id VARCHAR, ready BOOLEAN, exportable BOOLEAN", [("r1", True, True), ("r2", True, False), ("r3", False, False), ("r4", False, False), ("r5", False, False), ("r6", True, True), ("r7", True, True), ("", True, False)]))
def export_readiness(spark, d):
    return _readiness(dealt(spark, d, _ARTICLES, _ARTICLE)).select("doc_id", "id", "ready", "exportable")


@query(per_copy("id VARCHAR", [("r1",), ("r7",)], "id"))
def selection_pruned(spark, d):
    """Of five selected keys those that may still be exported: not r2 (source too short), r6 (no representative) or a lost one."""
    return records.still_selected(copied(spark, d, [(k,) for k in ("r1", "r2", "r6", "r7", "gone")], "id string", "id"), _readiness(copied(spark, d, _ARTICLES, _ARTICLE, "id")), "id", F.col("exportable"))


@query("""SELECT row_number() OVER (ORDER BY CASE category WHEN 'bismayah' THEN 1 WHEN 'politics' THEN 2 WHEN 'security' THEN 3 WHEN 'economy' THEN 4 ELSE 99 END, at_time, id) AS place, id FROM (
  SELECT doc_id AS id, CASE lang WHEN 'en' THEN 'politics' WHEN 'fr' THEN 'economy' WHEN 'de' THEN 'security' ELSE lang END AS category, CASE WHEN doc_id % 5 > 0 THEN TIMESTAMP '2024-01-01' + to_minutes(doc_id) ELSE TIMESTAMP '1970-01-01' END AS at_time
  FROM documents ORDER BY length(text) DESC, doc_id LIMIT 40)""")
def export_order(spark, d):
    """The order of an export of the forty longest documents; an export holds no more."""
    from pyspark.sql import Window

    a = Tables(spark, d).articles().orderBy(F.length("body").desc(), "id").limit(records.EXPORT_ROWS)
    category = F.when(F.col("category") == "en", "Politics").when(F.col("category") == "fr", "economy").when(F.col("category") == "de", "security").otherwise(F.col("category"))
    place = F.row_number().over(Window.orderBy(*records.export_order(category, F.when(F.col("id") % 5 > 0, F.col("published_at")), F.col("id"))))
    return a.select(place.cast("bigint").alias("place"), "id")


@query(fixed("request VARCHAR, problem VARCHAR, n BIGINT", [("fine", None, 1), ("empty", "NOTHING_SELECTED", 0), ("dates", "DATES", 1), ("unfit", "NOT_TRANSLATED", 2), ("outside", "OUTSIDE_PERIOD", 2), ("many", "TOO_MANY", 41)]))
def export_requests(spark, d):
    rows = _articles(spark)
    some = lambda *keys: rows.where(F.col("id").isin(*keys))
    many = spark.range(41).select(F.lit(True).alias("exportable"), NOW().alias("published_at"))
    asked = {"fine": (some("r1"), "2026-08-01", "2026-08-03"), "empty": (some("gone"), "2026-08-01", "2026-08-03"), "dates": (some("r1"), None, "2026-08-03"), "unfit": (some("r1", "r2"), "2026-08-01", "2026-08-03"),
             "outside": (some("r1", "r7"), "2026-08-01", "2026-08-03"), "many": (many, "2026-08-01", "2026-08-09")}
    out = None
    for name, (selected, start, end) in asked.items():
        one = records.export_verdict(selected, start, end, F.col("exportable")).select(F.lit(name).alias("request"), "problem", "n")
        out = one if out is None else out.unionByName(one)
    return out


_TRANSLATED = [
    ("fine", "COMPLETED", "V1", True, True, None, ""), ("stale", "COMPLETED", "V1", False, True, None, "STALE"), ("marks", "completed", "V1", True, None, "s", "NOT_MARKED_FULL|SUMMARY_PRESENT"),
    ("legacy", "COMPLETED", "V0", False, None, None, "LEGACY"), ("pending", "PENDING", "V1", None, None, None, ""), ("null", "COMPLETED", "V1", None, None, "x", "STALE|NOT_MARKED_FULL|SUMMARY_PRESENT"),
]


@query(per_document("id VARCHAR, errors VARCHAR, status VARCHAR, reset VARCHAR", [(r[0], r[6], "PENDING" if r[2] == "V0" else r[1], "LEGACY_TRANSLATION_HIDDEN_IN_BROWSER" if r[2] == "V0" else None) for r in _TRANSLATED]))
def translation_validity(spark, d):
    """What is wrong with stored translations, and how those of another pipeline are hidden."""
    rows = dealt(spark, d, [r[:6] for r in _TRANSLATED], "id string, status string, version string, current boolean, full boolean, summary string")
    errors = records.translation_errors(F.col("status"), F.col("version"), "V1", F.col("current"), F.col("full"), F.col("summary"))
    shown = records.guarded(F.col("status"), F.col("version"), F.lit("t"), F.lit("x"), "V1")
    return rows.select("doc_id", "id", F.array_join(errors, "|").alias("errors"), shown["status"].alias("status"), shown["reset_reason"].alias("reset"))


_CARDS = [("fine", "COMPLETED", True, "COMPLETED", True, False, None, ""), ("stale", "COMPLETED", None, "COMPLETED", False, False, None, "STALE_FACTS|STALE_CARD"), ("claims", None, None, "COMPLETED", True, None, "t", "CLAIMS_FULL_TRANSLATION|FULL_TEXT_IN_CARD"), ("none", None, None, None, None, None, "t", "")]


@query(per_document("id VARCHAR, errors VARCHAR", [(r[0], r[7]) for r in _CARDS]) + " UNION ALL SELECT NULL, 'input', 'full_text'")
def card_validity(spark, d):
    """What is wrong with stored cards; and which columns the input of the card stage must not have."""
    rows = dealt(spark, d, [r[:7] for r in _CARDS], "id string, fs string, fc boolean, cs string, cc boolean, full boolean, full_text string")
    errors = records.card_errors(*(F.col(c) for c in ("fs", "fc", "cs", "cc", "full", "full_text")))
    leaked = spark.createDataFrame([("input", "|".join(records.leaked_columns(rows, ("full_text", "body"))), None)], "id string, errors string, doc_id bigint")
    return rows.select("doc_id", "id", F.array_join(errors, "|").alias("errors")).unionByName(leaked)


_BASE = [("a", "2026-08-01", None, "old"), ("b", "", "2026-07-30", "old"), ("c", "2026-06-01", "2026-08-01", "old"), ("d", None, None, "old"), ("", "2026-08-01", None, "old"), ("e", "1960-01-01", "2026-08-02", "old"), ("f", "not a date", "2026-08-02", "old")]
_CURRENT = [("a", "2026-08-01", None, "new"), ("g", "2026-08-03", None, "new"), ("h", "2026-01-01", None, "new")]


@query(per_copy("id VARCHAR, version VARCHAR, restored BOOLEAN", [("a", "new", False), ("g", "new", False), ("b", "old", True), ("e", "old", True), ("f", "old", True)], "id"))
def retention_by_stamps(spark, d):
    schema = "id string, published string, discovered string, version string"
    base, current = copied(spark, d, _BASE, schema, "id"), copied(spark, d, _CURRENT, schema, "id")
    return records.kept_base(base, current, "id", ["published", "discovered"], NOW()).select("id", "version", "restored")


_RESOLVED = [("a", "", "FAILED"), ("b", "https://b.example/1", "RESOLVED"), ("c", "", "RESOLVED"), ("d", "", "FAILED"), ("e", None, None)]
_OFFERS = [("a", "https://x.example/1", True), ("b", "https://x.example/2", True), ("c", "https://x.example/3", True), ("d", "https://x.example/4", None), ("e", "", True), ("e", "https://x.example/5", True)]


@query(per_copy("id VARCHAR, url VARCHAR, url_status VARCHAR, method VARCHAR", [
    ("a", "https://x.example/1", "RESOLVED", "PRIORITY_AGGREGATOR_FALLBACK"), ("b", "https://b.example/1", "RESOLVED", None), ("c", "https://x.example/3", "RESOLVED", "PRIORITY_AGGREGATOR_FALLBACK"),
    ("d", "", "FAILED", None), ("e", "https://x.example/5", "RESOLVED", "PRIORITY_AGGREGATOR_FALLBACK")], "id"))
def aggregator_fallback(spark, d):
    return records.with_fallback(copied(spark, d, _RESOLVED, "id string, url string, url_status string", "id"), copied(spark, d, _OFFERS, "id string, fallback_url string, allow_fallback boolean", "id"))


@query(per_copy("id VARCHAR, origin VARCHAR, restored BOOLEAN", [("1", "seed", True), ("2", "index", True), ("3", "feed", False), ("4", "same", False)], "id"))
def snapshot_origins(spark, d):
    """Origins restored from a snapshot by id, else by title."""
    rows = copied(spark, d, [("1", "t1", "feed"), ("2", "t2", None), ("3", "t3", "feed"), ("4", "", "same")], "id string, title_key string, origin string", "id", "title_key")
    origins = copied(spark, d, [("1", "other", "seed"), (None, "t2", "index"), ("9", "", "x"), ("4", "t4", "same")], "id string, title_key string, origin string", "id", "title_key")
    return records.origin_restored(rows, origins).select("id", "origin", "restored")


@query(f"""SELECT url, max(page_id) AS page_id FROM (SELECT page_id, {_CANONICAL} AS url FROM pages) GROUP BY url""")
def last_item_by_url(spark, d):
    """The last page of each canonical URL."""
    items = Tables(spark, d).pages.select(F.col("page_id").alias("pos"), "url", F.col("page_id"), F.timestamp_seconds(F.col("page_id")).alias("published_at"))
    return records.last_by_url(items).select("url", "page_id")


@query("SELECT count(*) AS groups, count(*) FILTER (WHERE n > 1) AS merged, coalesce(sum(n - 1), 0)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)")
def corpus_totals(spark, d):
    return records.group_totals(Tables(spark, d).events.groupBy("user_id", "event_type").agg(F.count("*").alias("member_count")))


@query("SELECT event_type AS section, array_to_string(list_sort(list(DISTINCT CAST(ts AS DATE)::VARCHAR)), '|') AS days, count(DISTINCT user_id) AS clusters FROM events GROUP BY event_type")
def report_section_dates(spark, d):
    return records.section_dates(Tables(spark, d).events.select(F.col("event_type").alias("section"), F.to_date("ts").alias("day"), F.col("user_id").alias("cluster_id")))


@query(per_document("day DATE, first DATE, last DATE", [("2026-08-05", "2026-07-29", "2026-08-04"), ("2026-03-01", "2026-02-22", "2026-02-28")]))
def report_ranges(spark, d):
    rows = dealt(spark, d, [("2026-08-05",), ("2026-03-01",)], "s string").select("doc_id", F.to_date("s").alias("day"))
    return rows.select("doc_id", "day", records.report_range(F.col("day")).alias("r")).select("doc_id", "day", F.col("r.start").alias("first"), F.col("r.end").alias("last"))


_STATES = [("new", "text", None, None, True, True), ("failed", "text", "FAILED", None, False, True), ("empty", " ", None, None, False, False), ("other", "text", None, False, True, False), ("done", "text", "FULL_TEXT", True, True, False)]


@query(per_document("id VARCHAR, has_text BOOLEAN, work BOOLEAN", [(r[0], *r[4:]) for r in _STATES]))
def work_states(spark, d):
    rows = dealt(spark, d, [r[:4] for r in _STATES], "id string, text string, status string, representative boolean")
    done = F.col("id") == "done"
    return rows.select("doc_id", "id", records.has_full_text(F.col("text"), F.col("status")).alias("has_text"), records.needs_work(F.col("representative"), F.col("text"), done, 2).alias("work"))


_CURRENT_ROWS = [("same", "COMPLETED", "V1", "h", "g", True, "COMPLETED"), ("version", "COMPLETED", "V0", "h", "g", False, "PENDING"), ("source", "COMPLETED", "V1", "x", "g", False, "PENDING"), ("terms", "COMPLETED", "V1", "h", "y", False, "PENDING"), ("untold", "COMPLETED", "V1", "h", None, True, "COMPLETED"), ("pending", "PENDING", "V1", "h", "g", False, "PENDING")]


@query(per_document("id VARCHAR, is_current BOOLEAN, status VARCHAR", [(r[0], *r[5:]) for r in _CURRENT_ROWS]))
def derived_is_current(spark, d):
    rows = dealt(spark, d, [r[:5] for r in _CURRENT_ROWS], "id string, status string, version string, hash string, terms string")
    now = rows.withColumn("is_current", incremental.is_current(F.col("status"), F.col("version"), "V1", F.col("hash"), F.lit("h"), F.col("terms"), F.lit("g")))
    return now.select("doc_id", "id", "is_current", incremental.reconcile(F.col("status"), F.col("is_current")).alias("status"))


@query(per_copy("n INT, target BIGINT", [(1, 10), (3, 11), (4, None), (5, None), (6, None)], "n", "target"))
def priority_upsert(spark, d):
    """Candidates by URL, else by title, of the existing; one a URL and a title, those without a title apart."""
    existing = copied(spark, d, [(10, "u1", "t1"), (11, "u9", "t3")], "id bigint, url string, title string", "id", "url", "title")
    found = copied(spark, d, [(1, "u1", "other"), (2, "u1", "again"), (3, "u3", "t3"), (4, "u4", None), (5, "u5", None), (6, "u6", "t6"), (7, "u7", "t6")], "n int, url string, title string", "n", "url", "title")
    return incremental.upsert(existing, found, "url", "title", [F.col("n")]).select("n", "target")


_URLS = [
    ("https://a.example/news/2026/story", True, True, True, False), ("https://a.example/", False, False, False, False), ("https://a.example/tag/oil", False, False, False, False), ("https://a.example/a.pdf", False, False, False, False),
    ("https://a.example/x", True, False, False, False), ("https://a.example/12345", True, True, True, False), ("https://a.example/search/oil", True, False, True, False), ("https://www.google.iq/a/b", True, False, True, True),
    ("https://x.com/a/1234", True, True, True, True), ("https://netx.com/a/1234", True, True, True, False), ("ftp://a.example/a/b", False, False, False, False), ("", False, False, False, True), ("https://a.example/%D8%A7%D8%AE%D8%A8/1", True, True, True, False),
]


@query(per_document("url VARCHAR, recover BOOLEAN, resolve BOOLEAN, priority BOOLEAN, no_publisher BOOLEAN", _URLS))
def url_article_like(spark, d):
    rows, u = dealt(spark, d, [r[:1] for r in _URLS], "url string"), F.col("url")
    return rows.select("doc_id", "url", *(discovery.article_like(u, k).alias(k) for k in ("recover", "resolve", "priority")), discovery.no_publisher(u).alias("no_publisher"))


_OWN = [("https://a.example/ar/1", "", True), ("https://m.a.example/ar/1", "/ar/", True), ("https://a.example/en/1", "/ar/", False), ("https://nota.example/1", "", False), ("", "", False)]


@query(per_document("url VARCHAR, prefix VARCHAR, own BOOLEAN", _OWN))
def url_own_domain(spark, d):
    rows = dealt(spark, d, [r[:2] for r in _OWN], "url string, prefix string")
    return rows.select("doc_id", "url", "prefix", discovery.own(F.col("url"), F.array(F.lit("a.example")), F.col("prefix")).alias("own"))


_SCORES = [("https://a.example/story/12345", 45.48), ("https://a.example/stories/12345", 30.56), ("https://a.example/newsletter", 0.44), ("https://a.example/iraq/x", 25.28)]


@query(per_document("url VARCHAR, score DOUBLE, best VARCHAR", [(u, s, "https://a.example/story/12345") for u, s in _SCORES]))
def url_candidate_score(spark, d):
    rows = dealt(spark, d, [r[:1] for r in _SCORES], "url string")
    best = urls.best_candidate(F.array(*(F.lit(u) for u, _ in _SCORES)))
    return rows.select("doc_id", "url", F.round(urls.candidate_score(F.col("url")), 2).alias("score"), best.alias("best"))


_CANONICAL = [("https://A.example:443/p?utm_source=x&id=1&mc_cid=2#top", "https://a.example/p?id=1", "https://a.example/p?id=1&mc_cid=2", "https://a.example/p?utm_source=x&id=1&mc_cid=2"), ("no url", "", "", "")]


@query(per_document("url VARCHAR, every VARCHAR, priority VARCHAR, fragment VARCHAR", _CANONICAL))
def url_canonical_variants(spark, d):
    rows, u = dealt(spark, d, [r[:1] for r in _CANONICAL], "url string"), F.col("url")
    return rows.select("doc_id", "url", urls.canonical(u).alias("every"), urls.canonical(u, urls.TRACKING[:3]).alias("priority"), urls.canonical(u, ()).alias("fragment"))


_RECENT = [("", True), (None, True), ("2026-08-01", True), ("2026-07-01", False), ("soon", False)]


@query(per_document("stamp VARCHAR, recent BOOLEAN", _RECENT))
def recent_items(spark, d):
    rows = dealt(spark, d, [r[:1] for r in _RECENT], "stamp string")
    return rows.select("doc_id", "stamp", discovery.recent(F.col("stamp"), _TS("stamp"), NOW(), 14).alias("recent"))


_FEED = "<rss><item><title>Report number one of the day</title><link>https://a.example/news/1</link><pubDate>Mon</pubDate></item><item><title></title><link>https://a.example/news/2</link></item><item><title>tag page</title><link>https://a.example/tag/2</link></item></rss>"
_ATOM = '<feed><entry><title><![CDATA[An &amp; entry]]></title><link rel="x" href="https://a.example/news/1?utm_source=f"/></entry></feed>'
_SITEMAP = "<urlset><url><loc>https://a.example/news/4</loc><news:title>From a map</news:title><lastmod>2026-08-01</lastmod></url></urlset>"
_LISTING = '<a href="/news/5">A title of more than eighteen characters</a><a href="/news/6">short</a><a href="https://b.example/news/7">A title of more than eighteen characters</a>'


@query(per_copy("source_id VARCHAR, place INT, url VARCHAR, title VARCHAR, method VARCHAR", [
    ("a", 1, "https://a.example/news/1", "Report number one of the day", "feed"), ("a", 2, "https://a.example/news/4", "From a map", "sitemap"), ("a", 3, "https://a.example/news/5", "A title of more than eighteen characters", "listing")], "source_id"))
def source_indexes(spark, d):
    """The index of a source from its feed, an Atom feed that repeats an item, its sitemap and a listing; a seventh endpoint is not read."""
    bodies = [("a", i, "https://a.example/", b, ["a.example"]) for i, b in enumerate((_FEED, _ATOM, _SITEMAP, _LISTING))] + [("a", 6, "https://a.example/", _FEED.replace("/news/1", "/news/9"), ["a.example"])]
    items = discovery.index_items(copied(spark, d, bodies, "source_id string, endpoint int, url string, body string, hosts array<string>", "source_id"))
    return discovery.source_index(items)


_REDIRECT = '<c-wiz data-n-au="https://a.example/1"></c-wiz><link rel="canonical" href="https://a.example/1"><meta property="og:url" content="https://a.example/2"><meta http-equiv="refresh" content="0;url=https://a.example/3">'


@query(per_document("candidates VARCHAR, embedded VARCHAR", [("https://a.example/1|https://a.example/2|https://a.example/3", "https://a.example/story")]))
def redirect_pages(spark, d):
    import base64

    token = base64.urlsafe_b64encode(b'\x08\x13"\x17https://a.example/story\xd2\x01\x00').decode().rstrip("=")
    rows = dealt(spark, d, [(_REDIRECT, token)], "html string, token string")
    return rows.select("doc_id", F.array_join(html.redirect_candidates(F.col("html")), "|").alias("candidates"), html.embedded_url(F.col("token")).alias("embedded"))


_ERRORS = [("The operation was aborted", "FETCH_TIMEOUT"), ("HTTP 404", "ARTICLE_REMOVED"), ("HTTP 403", "ACCESS_BLOCKED"), ("odd", "CONTENT_EXTRACTION_FAILED")]


@query(per_document("message VARCHAR, code VARCHAR", _ERRORS))
def fetch_errors(spark, d):
    return dealt(spark, d, [r[:1] for r in _ERRORS], "message string").select("doc_id", "message", rules.error_code(F.col("message")).alias("code"))


_LADDER = [("r", True, True, True, True, "RECOVERED_URL"), ("d", False, True, True, True, "DECODED_REDIRECT"), ("h", False, False, True, True, "HTTP_REDIRECT"), ("p", False, False, False, True, "PAGE_METADATA"), ("f", False, False, False, False, "FAILED")]


@query(per_document("id VARCHAR, method VARCHAR", [(r[0], r[5]) for r in _LADDER]))
def url_resolution(spark, d):
    rows = dealt(spark, d, [r[:5] for r in _LADDER], "id string, a boolean, b boolean, c boolean, e boolean")
    return rows.select("doc_id", "id", enrich.resolution(*(F.col(c) for c in "abce")).alias("method"))


@query(per_document("clean VARCHAR, joined VARCHAR, preview VARCHAR, input VARCHAR, decoded VARCHAR, blocks VARCHAR, united VARCHAR", [("a b|cde", "x\ny", "abc…", '{"title":"T t","body":"a b"}', "é A", "one\ntwo", "a|b|c")]))
def text_helpers(spark, d):
    """Lists cleaned, fields joined, previews, a model's input, numbered entities, blocks as lines, arrays united."""
    rows = Tables(spark, d).documents
    items, a, b = F.array(F.lit(" a  b "), F.lit(""), F.lit("cdef"), F.lit("g")), F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))
    return rows.select(
        "doc_id",
        F.array_join(text.clean_list(items, 2, 3), "|").alias("clean"), text.join_fields(F.lit("x"), F.lit(""), F.lit("y")).alias("joined"), text.preview(F.lit("abc def"), 3).alias("preview"),
        enrich.model_input(F.lit(" T  t "), F.lit("a\n b  c"), 3).alias("input"), html.decode_entities(F.lit("&#233; &#x41;"), numeric=True).alias("decoded"), html.strip_blocks(F.lit("<p>one</p><p>two</p>")).alias("blocks"),
        F.array_join(F.array_union(a, b), "|").alias("united"),
    )


@query("SELECT id, 'a' || id AS answer FROM (SELECT doc_id AS id FROM documents WHERE length(text) >= 300 ORDER BY length(text) DESC, doc_id DESC LIMIT 60)")
def batched_answers(spark, d):
    """Answers for the queue of the sixty longest documents in batches of ten, each a partition of its own; a second run asks for nothing."""
    folder = f"{shared_folder(spark)}/tidewire/batches-{uuid.uuid4().hex}"
    docs = Tables(spark, d).documents.select(F.col("doc_id").alias("id"), F.length("text").alias("n"))
    queue = enrich.work_queue(docs, F.col("n") >= 300, F.lit(False), F.col("n"), F.col("id"), 60).select("id")
    answer = lambda batch: batch.select("id", F.concat(F.lit("a"), F.col("id").cast("string")).alias("answer"))
    records.in_batches(queue, folder, 10, answer)

    def never(batch):
        raise AssertionError("asked again")

    return records.in_batches(queue, folder, 10, never).select("id", "answer")


@query(per_copy("id BIGINT, reason VARCHAR", [(1, None), (1, "OLDER"), (2, "SOURCE_CHANGED"), (3, "UNKNOWN_ID")], "id"))
def generated_still_current(spark, d):
    latest = copied(spark, d, [(1, "h"), (2, "new")], "id bigint, hash string", "id")
    generated = copied(spark, d, [(1, "h", 1), (1, "h", 2), (2, "old", 1), (3, "x", 1)], "id bigint, hash string, ts int", "id")
    return enrich.newest_current(latest, generated, "id", "hash", "ts").select("id", "reason")


@query(per_document("title VARCHAR, chars INT, full BOOLEAN, model VARCHAR, category VARCHAR, locked BOOLEAN, keyed VARCHAR", [("t" * 300, 4, True, "m", "economy", True, "u")]))
def stored_records(spark, d):
    """A translation as it is stored; a nested record with its category locked; an article's key; legacy columns dropped."""
    rows = Tables(spark, d).documents.select("doc_id", F.lit("t" * 400).alias("t"), F.lit(" abcd ").alias("x"), F.struct(F.lit("politics").alias("category"), F.lit(False).alias("locked")).alias("analysis"), F.lit(1).alias("legacy"))
    made = records.without(rows, ("legacy",)).select("*", records.translation_record(F.col("t"), F.col("x"), F.col("x"), F.lit("m"), "V1").alias("r"), records.locked(F.col("analysis"), F.lit("economy")).alias("a"))
    return made.select("doc_id", "r.title", "r.chars", "r.full", "r.model", "a.category", "a.locked", ids.article_key(F.lit(""), F.lit("u"), F.lit("i")).alias("keyed"))


_ESCAPED = "replace(replace({0}, '\\\\', '\\\\\\\\'), '\"', '\\\\\"')"


@query(f"""SELECT doc_id, sha256('{{"title":"' || {_ESCAPED.format("lang")} || '","facts":["' || {_ESCAPED.format("source")} || '"]}}') AS hash FROM documents""")
def facts_hashes(spark, d):
    return Tables(spark, d).documents.select("doc_id", records.facts_hash(F.col("lang"), F.array("source")).alias("hash"))


@query(fixed("form VARCHAR, pos BIGINT, id VARCHAR, n INT", [("envelope", 0, "a", 1), ("envelope", 1, "b", None), ("array", 0, "c", 3)]))
def payload_forms(spark, d):
    """A payload as an object with articles and as a bare array; a missing and a broken file are empty where they may be."""
    from pyspark.sql import types as T

    base = f"{shared_folder(spark)}/tidewire/payloads-{uuid.uuid4().hex}"
    for name, body in {"envelope": '{"schemaVersion": 1,\n "articles": [{"id": "a", "n": 1}, {"id": "b"}]}', "array": '[{"id": "c", "n": 3}]', "broken": '{"articles": [{"id"'}.items():
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{base}/{name}")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    read = lambda name: payloads.read_payload(spark, f"{base}/{name}", schema, required=False).select(F.lit(name).alias("form"), "pos", "id", "n")
    return read("envelope").unionByName(read("array")).unionByName(read("broken")).unionByName(read("missing"))


@query("SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0")
def snapshot_versions(spark, d):
    """The latest of the versions v9 and v10 of a snapshot of the documents."""
    folder, docs = f"{shared_folder(spark)}/tidewire/snapshots-{uuid.uuid4().hex}", Tables(spark, d).documents.select("doc_id", "source")
    for version, rest in (("v9", 1), ("v10", 0)):
        payloads.write_version(docs.where(F.col("doc_id") % 2 == rest), folder, version)
    return payloads.read_latest(spark, folder)


@query(per_copy("id VARCHAR, category VARCHAR, kept BOOLEAN", [("a", "economy", True), ("built", "bismayah", True)], "id"))
def configured_keywords(spark, d):
    """Enabled keywords of the wanted categories; the built-in ones take the place of the configured ones of theirs."""
    configured = copied(spark, d, [("a", "economy", True), ("b", "economy", False), ("c", "bismayah", True), ("e", "security", True)], "id string, category string, enabled boolean", "id")
    built_in = copied(spark, d, [("built", "bismayah", True)], "id string, category string, enabled boolean", "id")
    return payloads.enabled_rules(configured, built_in, "bismayah", ["economy", "bismayah"]).select("id", "category", F.lit(True).alias("kept"))


@query(per_document("id VARCHAR, title VARCHAR, url VARCHAR", [("a", "outer", "inner url"), ("b", "inner", None)]))
def flattened_records(spark, d):
    rows = dealt(spark, d, [("a", ("inner", "inner url"), "outer", ""), ("b", ("inner", None), "", None)], "id string, article struct<title:string,url:string>, title string, url string")
    return payloads.flattened(rows, "article", ["title", "url"]).select("doc_id", "id", "title", "url")


_SOURCE_RANKS = [("a", 1, 500, 4, False, 100900), ("b", 3, 0, 0, True, 305000)]


@query(per_document("id VARCHAR, score INT", [(r[0], r[5]) for r in _SOURCE_RANKS]))
def representative_scores(spark, d):
    rows = dealt(spark, d, [r[:5] for r in _SOURCE_RANKS], "id string, rank int, chars int, tokens int, translated boolean")
    return rows.select("doc_id", "id", events.representative_score(*(F.col(c) for c in ("rank", "chars", "tokens", "translated"))).alias("score"))


@query("SELECT event_id, ts, value FROM events ORDER BY coalesce(ts, TIMESTAMP '1970-01-01') DESC, value DESC NULLS LAST, event_id")
def newest_first(spark, d):
    e = Tables(spark, d).events
    return e.orderBy(*ranking.newest_first(F.col("ts").cast("timestamp"), F.col("value"), F.col("event_id"))).select("event_id", "ts", "value")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def streaming_counts(spark, d):
    """Counts by hour and type of a stream over the table, complete once the stream has read what there is."""
    from tidewire.streaming.incremental import counts_by_window, run_complete

    stream = spark.readStream.schema(Tables(spark, d).events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return run_complete(counts_by_window(stream, "ts", "60 days", "1 hour", "event_type"), "counts")


@query("""WITH newest AS (SELECT source, list(doc_id ORDER BY n_chars DESC, doc_id DESC) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) WHERE r <= 11 GROUP BY source)
  SELECT doc_id AS id, array_to_string(list_filter(ids, lambda x: x <> doc_id)[1:10], '|') AS related FROM documents JOIN newest USING (source)""")
def related_members(spark, d):
    """The other members of each document's source, the longest first, at most ten."""
    rows = Tables(spark, d).documents.select(F.col("doc_id").alias("id"), F.col("source").alias("component"), F.timestamp_seconds(F.col("n_chars")).alias("published_at"))
    return views.related(rows, most=10).select("id", F.array_join(F.transform("related", lambda x: x.cast("string")), "|").alias("related"))


_BLOCKED = [("https://hathalyoum.net/articles/123", True, "hathalyoum", "priority-source-index", False), ("https://hathalyoum.net/articles/123", None, "hathalyoum", "priority-source-index", True), ("https://a.example/1", None, None, None, False)]


@query(per_document("n BIGINT, forbidden BOOLEAN", [(i, r[4]) for i, r in enumerate(_BLOCKED)]))
def url_aggregator_policy(spark, d):
    from tidewire.operators.profiles import AGGREGATOR

    rows = dealt(spark, d, [(i, *r[:4]) for i, r in enumerate(_BLOCKED)], "n bigint, url string, flag boolean, source string, method string")
    exempt = urls.aggregator_exempt(*(F.col(c) for c in ("url", "flag", "source", "method")), *AGGREGATOR)
    return rows.select("doc_id", "n", urls.forbidden(F.col("url"), [AGGREGATOR[0]], exempt).alias("forbidden"))


@query(per_copy("id VARCHAR, value VARCHAR", [("a", "by url"), ("b", "by title"), ("c", None)], "id"))
def matched_by_key(spark, d):
    rows = copied(spark, d, [("a", "u1", "t1"), ("b", "u2", "t2"), ("c", "u3", "t3")], "id string, url string, title string", "id", "url", "title")
    other = copied(spark, d, [("u1", "x", "by url"), (None, "t1", "by title"), (None, "t2", "by title")], "url string, title string, value string", "url", "title")
    return incremental.coalesce_matches(rows, other, ["url", "title"], "value").select("id", "value")


_LEVELS = [(95, "URGENT"), (80, "IMPORTANT"), (70, "NOTABLE"), (60, "REFERENCE"), (40, "GENERAL"), (39, "LOW")]


@query(per_document("score INT, level VARCHAR", _LEVELS))
def importance_levels(spark, d):
    return dealt(spark, d, [r[:1] for r in _LEVELS], "score int").select("doc_id", "score", arabic_rules.importance_level(F.col("score")).alias("level"))


_ANSWERS = [
    ("named", r'[["wrb.fr","x","[\"garturlres\",\"https://a.example/story?id\\u003d1\",1]"]]', "https://a.example/story?id\\u003d1"), ("first", 'x "https://b.example/1" y', "https://b.example/1"), ("none", "nothing", ""),
]


@query(per_document("id VARCHAR, url VARCHAR", [("named", "https://a.example/story?id=1"), ("first", "https://b.example/1"), ("none", "")]))
def redirect_answers(spark, d):
    rows = dealt(spark, d, [r[:2] for r in _ANSWERS], "id string, answer string")
    return rows.select("doc_id", "id", html.batch_url(F.col("answer")).alias("url"))


@query(fixed("id VARCHAR", [("second",)]))
def alternate_payloads(spark, d):
    """The first file that is there: the recovered one is missing, the discovered one is read."""
    from pyspark.sql import types as T

    base = f"{shared_folder(spark)}/tidewire/alternates-{uuid.uuid4().hex}"
    spark.createDataFrame([('{"articles": [{"id": "second"}]}',)], "value string").coalesce(1).write.text(f"{base}/discovered")
    return payloads.read_first(spark, [f"{base}/recovered", f"{base}/discovered"], T.StructType([T.StructField("id", T.StringType())])).select("id")


_GLOSSARY = {"council": ["council", "que"], "project": ["keit", "lichkeit"], "city": ["tion"]}
_SQUEEZED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_OF = ", ".join("{'r': -greatest(" + ", ".join(f"CASE WHEN contains(both_, '{n}') THEN {len(n)} ELSE 0 END" for n in names) + f"), 't': '{t}'}}" for t, names in _GLOSSARY.items())


@query(f"""SELECT id, lower(category) AS category, {_SQUEEZED.format("source")} AS source, {_SQUEEZED.format("title")} AS title,
  array_to_string(list_transform(list_sort(list_filter([{_OF}], lambda s: s.r < 0)), lambda s: s.t), '|') AS terms FROM (SELECT *, title || chr(10) || body AS both_ FROM {ARTICLES})""")
def report_sources(spark, d):
    """What a report's writer is given of every article, with the glossary's terms in its title and text."""
    rows = Tables(spark, d).articles().select("id", "category", "source", "title", F.col("body").alias("text"), F.lit(None).cast("string").alias("url"))
    return enrich.report_source(rows, _GLOSSARY).select("id", "category", "source", "title", F.array_join("terms", "|").alias("terms"))


@query(per_document("id VARCHAR, url VARCHAR, url_status VARCHAR, error_code VARCHAR", [("bad", "", "PENDING", "FORBIDDEN_URL"), ("fine", "https://a.example/1", "RESOLVED", None), ("empty", "", "FAILED", None)]))
def sanitized_urls(spark, d):
    rows = dealt(spark, d, [("bad", "https://news.google.com/x", "RESOLVED"), ("fine", "https://a.example/1", "RESOLVED"), ("empty", "", "FAILED")], "id string, url string, url_status string")
    return records.sanitized(rows, discovery.no_publisher(F.col("url")))
