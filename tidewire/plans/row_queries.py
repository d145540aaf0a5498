"""Queries over rows: counts, dedupe, ranking, snapshots, views, quality, similarity, events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions.text import tokens, tokens_sql
from tidewire.operators import events, incremental, ranking, similarity, views
from tidewire.plans.registry import ARTICLES, Tables, query
from tidewire.streaming.incremental import first_seen, run_available

BUCKETS = ["view", "click", "purchase", "error", "signup"]


@query("SELECT category, count(*) AS n, count(DISTINCT source) AS sources FROM " + ARTICLES + " GROUP BY category")
def category_counts(spark, d):
    return Tables(spark, d).articles().groupBy("category").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@query("SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'click' AND value > 10) AS resolved FROM events GROUP BY user_id")
def conditional_counts(spark, d):
    return Tables(spark, d).events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.expr("event_type = 'error'")).alias("failed"), F.count_if(F.expr("event_type = 'click' and value > 10")).alias("resolved"))


_PICK = "SELECT {0} FROM (SELECT *, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_pos, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {1}) AS r FROM events) WHERE r = 1"


@query(_PICK.format("user_id, event_type, event_id, value, first_pos", "value DESC NULLS LAST, event_id"))
def dedupe_max_priority(spark, d):
    return ranking.keep_highest(Tables(spark, d).events, ["user_id", "event_type"], "value", "event_id").select("user_id", "event_type", "event_id", "value", "first_pos")


@query(_PICK.format("user_id, event_type, event_id", "event_id DESC"))
def dedupe_last_wins(spark, d):
    return ranking.keep_last(Tables(spark, d).events, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query(_PICK.format("user_id, event_type, event_id", "event_id"))
def dedupe_first_wins(spark, d):
    return ranking.keep_first(Tables(spark, d).events, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderdate DESC NULLS LAST, o_orderkey LIMIT 200")
def topk_importance(spark, d):
    order = [*ranking.by_importance(F.col("o_totalprice"), F.col("o_orderdate")), F.col("o_orderkey")]
    return Tables(spark, d).orders.orderBy(*order).limit(200).select("o_orderkey", "o_totalprice")


_BALANCED = """SELECT event_id, event_type, value, r AS turn FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events WHERE {0})
  WHERE list_contains(['view', 'click', 'purchase', 'error', 'signup'], event_type) ORDER BY r, list_position(['view', 'click', 'purchase', 'error', 'signup'], event_type) LIMIT {1}"""


@query(_BALANCED.format("true", 37))
def balanced_pick(spark, d):
    return ranking.balanced_pick(Tables(spark, d).events, "event_type", [F.col("value").desc(), F.col("event_id")], BUCKETS, 37).select("event_id", "event_type", "value", "turn")


@query(f"""WITH must AS (SELECT event_id, event_type, value, 0 AS turn FROM events WHERE value > 60 ORDER BY value DESC, event_id LIMIT 40),
  rest AS ({_BALANCED.format("NOT coalesce(value > 60, false)", 40)})
  SELECT event_id, event_type FROM (SELECT *, 0 AS b FROM must UNION ALL SELECT *, list_position(['view', 'click', 'purchase', 'error', 'signup'], event_type) FROM rest) ORDER BY turn, b, value DESC, event_id LIMIT 40""")
def mandatory_then_balanced(spark, d):
    e = Tables(spark, d).events
    return ranking.mandatory_then_balanced(e, F.col("value") > 60, "event_type", [F.col("value").desc(), F.col("event_id")], BUCKETS, 40).select("event_id", "event_type")


@query(f"SELECT id, title, quality FROM (SELECT a.id, a.title, quality FROM {ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id) ORDER BY quality DESC NULLS LAST, title, id")
def sort_nulls_last(spark, d):
    t = Tables(spark, d)
    rows = t.articles().select("id", "title").join(t.labels.select(F.col("doc_id").alias("id"), "quality"), "id", "left")
    return rows.orderBy(F.col("quality").desc_nulls_last(), "title", "id")


_TOP = f"""(SELECT a.id, category, CASE WHEN quality IS NOT NULL THEN published_at END AS at_time, title FROM {ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id)"""


@query(f"""SELECT id, category, place, listed FROM (
  SELECT id, category, 'newest' AS listed, row_number() OVER (PARTITION BY category ORDER BY at_time DESC NULLS LAST, CASE WHEN at_time IS NULL THEN title END COLLATE ar, id) AS place FROM {_TOP} WHERE at_time IS NULL OR id % 3 = 0
  UNION ALL SELECT id, category, 'untimed', row_number() OVER (PARTITION BY category ORDER BY title COLLATE ar, id) FROM {_TOP} WHERE at_time IS NULL) WHERE place <= 60""")
def sort_collated(spark, d):
    """The first 60 reports of each category as listed, newest first and those without a time by title in the locale's order; and the latter alone."""
    t = Tables(spark, d)
    rows = t.articles().join(t.labels.select(F.col("doc_id").alias("id"), "quality"), "id", "left").withColumn("at_time", F.when(F.col("quality").isNotNull(), F.col("published_at")))
    place = F.row_number().over(Window.partitionBy("category").orderBy(*ranking.by_time(F.col("at_time"), F.col("title")), "id"))
    first = lambda df, name: df.withColumn("place", place).where("place <= 60").select("id", "category", "place", F.lit(name).alias("listed"))
    return first(rows.where("at_time is null or id % 3 = 0"), "newest").unionAll(first(rows.where("at_time is null"), "untimed"))


_SETS = f"SELECT id, list_sort({tokens_sql("body", 3)}) AS s FROM {ARTICLES}"
_REPS = f"SELECT min(id) AS id, s FROM ({_SETS}) WHERE len(s) > 0 GROUP BY s"


@query(f"""WITH reps AS ({_REPS}), scored AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.s, b.s)) AS c, len(a.s) AS n, len(b.s) AS m FROM reps a JOIN reps b ON a.id < b.id
  AND least(len(a.s), len(b.s)) >= 0.5 * greatest(len(a.s), len(b.s))) SELECT a, b, c::DOUBLE / (n + m - c) AS similarity FROM scored WHERE c::DOUBLE / (n + m - c) >= 0.5""")
def set_similarity_pairs(spark, d):
    return similarity.similar_pairs(Tables(spark, d).articles().select("id", tokens(F.col("body")).alias("set")), 0.5)


@query(f"""SELECT s.id, min(s.id) OVER (PARTITION BY s.s) AS rep FROM ({_SETS}) s WHERE len(s.s) > 0""")
def set_classes(spark, d):
    a = Tables(spark, d).articles().select("id", tokens(F.col("body")).alias("s"))
    return similarity.set_classes(a, "id", "s")[1]


_ITEM, _ENTRY = tokens_sql("title", 3), tokens_sql("text", 3)


@query(f"""WITH i AS (SELECT id AS item_id, {_ITEM} AS t FROM {ARTICLES}), e AS (SELECT item_id AS entry_id, {_ENTRY} AS t FROM benchmark),
  p AS (SELECT item_id, entry_id, len(list_intersect(i.t, e.t)) AS c, len(i.t) AS n, len(e.t) AS m FROM i, e),
  s AS (SELECT item_id, entry_id, floor((0.7::DOUBLE * c / least(n, m) + 0.3::DOUBLE * c / (n + m - c)) * 10000 + 0.5) / 10000 AS similarity FROM p WHERE c > 0)
  SELECT item_id, entry_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, entry_id) AS r FROM s WHERE similarity >= 0.3) WHERE r = 1""")
def title_recovery_best(spark, d):
    t = Tables(spark, d)
    items = t.articles().select(F.col("id").alias("item_id"), tokens(F.col("title")).alias("tokens"))
    index = t.benchmark.select(F.col("item_id").alias("entry_id"), tokens(F.col("text")).alias("tokens"))
    return similarity.best_match(items, index, 0.3)


@query("""SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id < b.event_id AND abs(epoch(a.ts) - epoch(b.ts)) <= 3600""")
def interval_pairs(spark, d):
    return similarity.within_interval(Tables(spark, d).events, "user_id", "event_id", "ts", 1)


_F = f"""f AS (SELECT id, category, published_at, lower(trim(regexp_replace(regexp_replace(title, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), '\\s+', ' ', 'g'))) AS title, {tokens_sql("title", 3)} AS tt,
  {tokens_sql("left(title || chr(10) || body, 1400)", 3)} AS lt, list_distinct(regexp_extract_all(title || chr(10) || left(body, 1400), '\\b[0-9]+(?:[.,][0-9]+)?\\b')) AS nt FROM {ARTICLES}),
 p AS (SELECT a.id AS a, b.id AS b, a.title AS x, b.title AS y, len(list_intersect(a.tt, b.tt)) AS c, len(a.tt) AS n, len(b.tt) AS m, len(list_intersect(a.lt, b.lt)) AS lc, len(a.lt) AS ln, len(b.lt) AS lm,
   len(list_intersect(a.nt, b.nt)) AS nc, len(a.nt) + len(b.nt) AS nn
  FROM f a JOIN f b ON a.category = b.category AND a.id < b.id WHERE abs(epoch(a.published_at) - epoch(b.published_at)) <= 259200 AND list_has_any(a.tt, b.tt)),
 q AS (SELECT *, c::DOUBLE / (n + m - c) AS tj, c::DOUBLE / least(n, m) AS tov, CASE WHEN ln > 0 AND lm > 0 THEN lc::DOUBLE / (ln + lm - lc) ELSE 0 END AS lj, CASE WHEN nn > nc THEN nc::DOUBLE / (nn - nc) ELSE 0 END AS nj,
  least(length(x), length(y)) >= 18 AND (contains(x, y) OR contains(y, x)) AS exact FROM p),
 pairs AS (SELECT a, b, least(0.29::DOUBLE * tj + 0.29::DOUBLE * tov + 0.18::DOUBLE * lj + 0.12::DOUBLE * nj + 0.14::DOUBLE * exact::INT, 1.0) AS score FROM q
  WHERE exact OR (c >= 3 AND tov >= 0.67) OR (c >= 2 AND tov >= 0.45 AND (nc > 0 OR lj >= 0.16))),
 edges AS (SELECT a, b FROM pairs WHERE score >= 0.5), both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
 walk AS (SELECT id AS a, id AS b FROM f UNION SELECT w.a, e.b FROM walk w JOIN both_ways e ON w.b = e.a),
 parts AS (SELECT a AS id, min(b) AS component FROM walk GROUP BY a)"""


def _features(t: Tables):
    return events.features(t.articles())


@query(f"WITH RECURSIVE {_F} SELECT a, b, round(score, 6) AS score FROM pairs WHERE score >= 0.5")
def event_pairs(spark, d):
    return events.match_edges(_features(Tables(spark, d))).withColumn("score", F.round("score", 6))


def _groups(spark, d):
    t = Tables(spark, d)
    a = t.articles().select("id", "source", "published_at", F.length("body").alias("chars"))
    return events.event_groups(a, events.group_edges(_features(t)), F.col("chars"))


@query(f"""WITH RECURSIVE {_F} SELECT p.id, p.component, first_value(p.id) OVER w AS representative_id, count(*) OVER (PARTITION BY p.component) AS member_count,
  p.id = first_value(p.id) OVER w AS is_representative FROM parts p JOIN {ARTICLES} a ON a.id = p.id WINDOW w AS (PARTITION BY p.component ORDER BY length(a.body) DESC, p.id)""")
def event_groups(spark, d):
    return _groups(spark, d)[0].select("id", "component", "representative_id", "member_count", "is_representative")


@query(f"""WITH RECURSIVE {_F} SELECT component, count(*) AS member_count, count(*) - 1 AS duplicate_count, min(published_at) AS published_from, max(published_at) AS published_to,
  'event-' || left(replace(replace(replace(to_base64(unhex(sha256(array_to_string(list_sort(list(p.id::VARCHAR)), '|')))), '+', '-'), '/', '_'), '=', ''), 18) AS group_id
  FROM parts p JOIN {ARTICLES} a ON a.id = p.id GROUP BY component""")
def event_group_stats(spark, d):
    return _groups(spark, d)[1].select("component", "member_count", "duplicate_count", "published_from", "published_to", "group_id")


_SPLIT = "current AS (SELECT * FROM documents WHERE doc_id % 3 <> 0), previous AS (SELECT *, TIMESTAMP '2024-01-01' + to_days((doc_id % 20)::INT) AS checked FROM documents WHERE doc_id % 2 = 0)"


def _split(t: Tables):
    docs = t.documents
    return docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 2 = 0").withColumn("checked", F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 20) * 86400))


@query(f"""WITH {_SPLIT} SELECT c.doc_id, CASE WHEN p.doc_id IS NULL THEN 'new' ELSE 'recheck' END AS reason FROM current c LEFT JOIN previous p ON c.doc_id = p.doc_id
  WHERE NOT coalesce(length(p.text) > 1000 AND p.checked > TIMESTAMP '2024-01-15' - INTERVAL 7 DAYS, false)""")
def incremental_pending(spark, d):
    current, previous = _split(Tables(spark, d))
    due = incremental.due_for_recheck(F.col("checked"), F.lit("2024-01-15").cast("timestamp"))
    return incremental.pending(current, previous, "doc_id", F.length("text") > 1000, due).select("doc_id", "reason")


@query("""SELECT c.doc_id, CASE WHEN p.doc_id IS NULL THEN 'new' WHEN p.hash = '' THEN 'unknown' WHEN p.hash = c.hash THEN 'reused' ELSE 'changed' END AS state, CASE WHEN p.hash = c.hash AND p.hash <> '' THEN p.note END AS note
  FROM (SELECT doc_id, md5(text) AS hash FROM documents WHERE doc_id % 3 <> 0) c LEFT JOIN (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN md5('x') ELSE md5(text) END AS hash, lang AS note FROM documents WHERE doc_id % 2 = 0) p ON c.doc_id = p.doc_id""")
def incremental_merge(spark, d):
    docs = Tables(spark, d).documents
    current = docs.where("doc_id % 3 <> 0").select("doc_id", F.md5(F.col("text").cast("binary")).alias("hash"))
    old = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, F.md5(F.lit("x").cast("binary"))).otherwise(F.md5(F.col("text").cast("binary")))
    previous = docs.where("doc_id % 2 = 0").select("doc_id", old.alias("hash"), F.col("lang").alias("note"), F.col("doc_id").alias("pos"))
    return incremental.carry_over(current, previous, "doc_id", "pos", "hash", ["note"]).select("doc_id", "state", "note")


@query("""SELECT doc_id, true AS restored FROM documents WHERE doc_id % 2 = 0 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0) UNION ALL SELECT doc_id, false FROM documents WHERE doc_id % 3 <> 0""")
def base_restore(spark, d):
    current, base = _split(Tables(spark, d))
    return incremental.restore_base(base.select("doc_id"), current.select("doc_id"), "doc_id")


@query("SELECT url FROM (SELECT DISTINCT url FROM pages WHERE page_id % 2 = 0) WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def seed_insert(spark, d):
    pages = Tables(spark, d).pages
    return incremental.insert_missing(pages.where("page_id % 2 = 0").select("url").distinct(), pages.where("page_id % 3 = 0").select(F.col("url").alias("u"), F.lit("").alias("v")), "url", ["u", "v"])


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, g DESC, event_id DESC) AS r FROM (SELECT *, event_id % 2 AS g FROM events)) WHERE r = 1""")
def lww_merge(spark, d):
    last = lambda e: ranking.first_by(e, ["user_id"], F.col("ts").desc_nulls_last(), F.col("event_id").desc())
    e = Tables(spark, d).events
    return incremental.last_write_wins(last(e.where("event_id % 2 = 0")), last(e.where("event_id % 2 = 1")), "user_id", "ts").select("user_id", "event_id")


@query("SELECT event_id FROM events WHERE CAST(ts + INTERVAL 9 HOURS AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'")
def rolling_window_kst(spark, d):
    return Tables(spark, d).events.where(incremental.in_rolling_days(F.col("ts"), F.lit("2024-01-20").cast("date"), 7)).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAYS")
def rolling_window_utc(spark, d):
    return Tables(spark, d).events.where(incremental.in_rolling_hours(F.lit("x"), F.col("ts"), F.lit("2024-01-20").cast("timestamp"), 7)).select("event_id")


@query("""WITH r AS (SELECT role AS section, (turn * 10000 + conv_id)::BIGINT AS item_index, conv_id % 50 AS cluster_id, count(*) OVER (PARTITION BY role, turn * 10000 + conv_id) AS c FROM conversations),
  j AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, section IN ('user', 'assistant') ORDER BY c, (section <> CASE WHEN cluster_id % 2 = 0 THEN 'user' ELSE 'assistant' END)::INT, section, item_index) AS p FROM r)
  SELECT section, item_index, cluster_id, CASE WHEN cluster_id >= 40 THEN 'unknown-cluster' WHEN section NOT IN ('user', 'assistant') THEN 'section-not-allowed:' || section WHEN p > 1 THEN 'duplicate-reference' END AS reason FROM j""")
def cluster_reference_keeper(spark, d):
    refs = Tables(spark, d).conversations.select(F.col("role").alias("section"), (F.col("turn") * 10000 + F.col("conv_id")).alias("item_index"), (F.col("conv_id") % 50).alias("cluster_id"))
    clusters = spark.range(40).select(F.col("id").alias("cluster_id"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("target_section"), F.array(F.lit("user"), F.lit("assistant")).alias("allowed_sections"))
    kept, rejected = ranking.cluster_keepers(refs, clusters)
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)


@query("SELECT lang, source, count(*) AS n, GROUPING(lang) * 2 + GROUPING(source) AS level FROM documents GROUP BY ROLLUP (lang, source)")
def facet_counts(spark, d):
    return views.facet_counts(Tables(spark, d).documents, "lang", "source")


@query(f"""SELECT id FROM (SELECT a.*, l.quality * 95 AS score FROM {ARTICLES} a LEFT JOIN labels l ON a.id = l.doc_id) WHERE category = 'en' AND score >= 90 AND score < 101 AND contains(lower(body), 'tion')""")
def faceted_filter(spark, d):
    t = Tables(spark, d)
    rows = t.articles().join(t.labels.select(F.col("doc_id").alias("id"), (F.col("quality") * 95).alias("score")), "id", "left")
    return views.filtered(rows, category="en", bucket="90+", words="TION", text="body").select("id")


@query("""SELECT 'TOO_SHORT' AS rule, 'error' AS severity, doc_id::VARCHAR AS id FROM documents WHERE length(text) < 300 UNION ALL SELECT 'WRONG_LENGTH', 'warning', doc_id::VARCHAR FROM documents WHERE n_chars <> length(text)
  UNION ALL SELECT 'UNKNOWN_LANG', 'error', doc_id::VARCHAR FROM documents WHERE lang NOT IN ('en', 'de', 'fr') UNION ALL SELECT 'REPEATED_ID', 'error', url FROM pages GROUP BY url HAVING count(*) > 1""")
def quality_violations(spark, d):
    t = Tables(spark, d)
    rules = {"TOO_SHORT": ("error", F.length("text") < 300), "WRONG_LENGTH": ("warning", F.col("n_chars") != F.length("text")), "UNKNOWN_LANG": ("error", ~F.col("lang").isin("en", "de", "fr"))}
    return views.violations(t.documents, "doc_id", rules).unionByName(views.repeated_ids(t.pages, "url"))


@query("""SELECT n_name, o_orderpriority, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, o_orderpriority)""")
def star_category_rollup(spark, d):
    t = Tables(spark, d)
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.rollup("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def streaming_incremental(spark, d):
    """One event of each user and type, the first to arrive, by a stream over the table: its keys."""
    schema = Tables(spark, d).events.schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return run_available(first_seen(stream, ["user_id", "event_type"], "ts", "60 days"), "first-seen").select("user_id", "event_type")
