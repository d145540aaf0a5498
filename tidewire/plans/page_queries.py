"""Queries over fetched pages: URLs and what the HTML holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.functions.text import BLANKS
from tidewire.operators import discovery
from tidewire.plans.registry import Tables, query
from tidewire.sources import html

_HOST = "regexp_replace(lower(regexp_extract({0}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '')"
_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"
_KEPT = f"array_to_string(list_filter(string_split({_QUERY}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_|fbclid|gclid|mc_)')), '&')"
#: A page's canonical URL.
_CANONICAL = f"""regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1) || '://' || lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))
  || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || CASE WHEN {_KEPT} <> '' THEN '?' || {_KEPT} ELSE '' END"""


def _strip(sql: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({sql}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '{BLANKS}', ' ', 'g'))"


def _decoded(sql: str) -> str:
    for name, char in html.ENTITIES.items():
        sql = f"replace({sql}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return sql


@query(f"""SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1) || '://' || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)
  || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || CASE WHEN {_KEPT} <> '' THEN '?' || {_KEPT} ELSE '' END AS url, {_HOST.format("url")} AS host FROM pages""")
def url_canonicalize(spark, d):
    return Tables(spark, d).pages.select("page_id", urls.canonical(F.col("url")).alias("url"), urls.hostname(F.col("url")).alias("host"))


@query(f"""SELECT page_id, length({_PATH}) >= 5 AND (regexp_matches({_PATH}, '[0-9]{{4,}}') OR regexp_matches({_PATH}, '/[^/]+/[^/]+')) AS article_like,
  {_HOST.format("url")} = '' OR {_HOST.format("url")} LIKE '%.example.net' OR {_HOST.format("url")} = 'example.net' AS forbidden FROM pages""")
def url_policies(spark, d):
    u = F.col("url")
    return Tables(spark, d).pages.select("page_id", urls.article_like(u).alias("article_like"), urls.forbidden(u, ["example.net"]).alias("forbidden"))


@query(f"""SELECT page_id, {_decoded(_strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title, {_decoded(_strip("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"))} AS heading,
  nullif(regexp_extract(html, '(?is)<meta[^>]+(?:name|property)=["'']description["''][^>]*content=["'']([^"'']*)["'']', 1), '') AS description FROM pages""")
def html_title(spark, d):
    h = F.col("html")
    return Tables(spark, d).pages.select("page_id", html.title(h).alias("title"), html.heading(h).alias("heading"), html.meta(h, "description").alias("description"))


@query(f"""SELECT page_id, {_decoded("t")} AS body, length({_decoded("t")})::INT AS chars FROM (SELECT page_id, coalesce(list_sort(list_transform(regexp_extract_all(html, '(?is)<(?:article|main)[^>]*>(.*?)</(?:article|main)>', 1),
  lambda b: {{'n': length({_strip("b")}), 't': {_strip("b")}}}), 'DESC')[1].t, '') AS t FROM pages)""")
def html_best_text(spark, d):
    return Tables(spark, d).pages.select("page_id", html.best_text(F.col("html")).alias("body")).select("page_id", "body", F.length("body").alias("chars"))


_LINKS = """SELECT url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>.*?</a>', 1)) AS href FROM pages"""


@query(f"""SELECT host, count(*) AS links, count(DISTINCT url) AS pages FROM (SELECT url, {_HOST.format("CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '//%' THEN 'http:' || href ELSE url END")} AS host FROM ({_LINKS})) GROUP BY host""")
def html_link_counts_by_host(spark, d):
    found = html.links(Tables(spark, d).pages, least_text=0)
    return found.groupBy("host").agg(F.count("*").alias("links"), F.count_distinct("url").alias("pages"))


_TITLE_SQL = _decoded(_strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))
_GRAPH = f"""(SELECT page_id, path, type, headline, name, url FROM (SELECT page_id, url AS u, {_TITLE_SQL} AS t, {_HOST.format("url")} AS h FROM pages WHERE page_id % 10 <> 9), LATERAL (VALUES
  ('$', NULL, NULL, NULL, NULL), ('$.@graph[0]', 'NewsArticle', t, NULL, u), ('$.@graph[0].author', 'Person', NULL, h, NULL), ('$.@graph[1]', 'WebPage ItemPage', NULL, t, NULL)) n(path, type, headline, name, url))"""


def _with_metadata(t: Tables):
    """Pages with an ld+json script made of their own title, URL and host; of every tenth it doesn't parse."""
    p = t.pages.select("page_id", "url", "html", html.title(F.col("html")).alias("_t"), urls.hostname(F.col("url")).alias("_h"))
    article = F.struct(F.lit("NewsArticle").alias("@type"), F.col("_t").alias("headline"), "url", F.struct(F.lit("Person").alias("@type"), F.col("_h").alias("name")).alias("author"))
    page = F.struct(F.array(F.lit("WebPage"), F.lit("ItemPage")).alias("@type"), F.col("_t").alias("name"))
    graph = F.concat(F.lit('{"@graph":['), F.to_json(article), F.lit(","), F.to_json(page), F.lit("]}"))
    script = F.concat(F.lit('<script type="application/ld+json">'), F.when(F.col("page_id") % 10 == 9, F.lit("{")).otherwise(graph), F.lit("</script>"))
    return p.select("page_id", "url", F.concat(script, "html").alias("html"))


@query(f"SELECT page_id, path, type, headline, name, url FROM {_GRAPH}")
def json_ld_nodes(spark, d):
    """Every object of the ld+json scripts of every page."""
    return html.json_ld_nodes(_with_metadata(Tables(spark, d))).select("page_id", "path", "type", "headline", "name", "url")


@query(f"SELECT type, count(*) AS nodes, count(DISTINCT page_id) AS pages FROM {_GRAPH} GROUP BY type")
def json_ld_pages(spark, d):
    """Objects of each type and the pages that hold them."""
    return html.json_ld_nodes(_with_metadata(Tables(spark, d))).groupBy("type").agg(F.count("*").alias("nodes"), F.count_distinct("page_id").alias("pages"))


_H1_SQL = _decoded(_strip("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"))
_CANONICAL3 = _CANONICAL.replace("|mc_", "")


@query(f"""SELECT page_id, nullif({_H1_SQL}, '') AS title, CASE page_id % 3 WHEN 0 THEN TIMESTAMP '2024-01-01' + to_days((page_id % 28)::INT) WHEN 1 THEN TIMESTAMP '2024-02-01' + to_days((page_id % 28)::INT) END AS date,
  CASE WHEN page_id % 2 = 0 THEN 'About ' || page_id END AS description, {_CANONICAL3} AS canonical FROM pages""")
def page_infos(spark, d):
    """Title, date, description and canonical URL of every page, given metadata by its number and a canonical link to itself."""
    day = lambda month: F.date_format(F.date_add(F.lit(f"2024-{month}-01").cast("date"), (F.col("page_id") % 28).cast("int")), "yyyy-MM-dd")
    tag = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    dated = F.when(F.col("page_id") % 3 == 0, tag('<meta content="', day("01"), 'T00:00:00Z" property="article:published_time">')).when(F.col("page_id") % 3 == 1, tag('<time datetime="', day("02"), 'T00:00:00Z"></time>')).otherwise("")
    about = F.when(F.col("page_id") % 2 == 0, tag('<meta name="description" content="About ', F.col("page_id").cast("string"), '">')).otherwise("")
    p = Tables(spark, d).pages.select("page_id", "url", F.concat(dated, about, tag('<link rel="canonical" href="', F.col("url"), '">'), "html").alias("html"))
    return p.select("page_id", *(c.alias(n) for n, c in discovery.page_info(F.col("html"), F.col("url")).items()))


@query(f"""WITH p AS (SELECT a.page_id, a.url AS own, {_HOST.format("a.url")} AS h, b.url AS u1, {_HOST.format("b.url")} AS h1, c.url AS u2, {_HOST.format("c.url")} AS h2 FROM pages a JOIN pages b ON b.page_id = a.page_id + 1 JOIN pages c ON c.page_id = a.page_id + 2),
  picked AS (SELECT own, min(page_id) AS page_id, count(*) AS n FROM p GROUP BY own), fit AS (SELECT p.own, p.page_id, h1 <> h AND NOT suffix(h1, '.' || h) AS ok1, h2 <> h AND NOT suffix(h2, '.' || h) AS ok2, u1, u2 FROM p JOIN picked USING (own) WHERE n = 1)
  SELECT page_id, {_CANONICAL3} AS link FROM (SELECT page_id, CASE WHEN ok2 AND page_id % 2 = 0 THEN u2 WHEN ok1 THEN u1 ELSE u2 END AS url FROM fit WHERE ok1 OR ok2)""")
def publisher_links(spark, d):
    """The publisher's link of every page that names the two pages after it; on even pages the second says that it is the source."""
    p = Tables(spark, d).pages.select("page_id", "url")
    shifted = lambda n, name: p.select((F.col("page_id") - n).alias("page_id"), F.col("url").alias(name))
    anchor = lambda u, label: F.concat(F.lit('<a href="'), u, F.lit('">'), label, F.lit("</a>"))
    page = F.concat(anchor(F.col("u1"), F.lit("more")), anchor(F.col("u2"), F.when(F.col("page_id") % 2 == 0, "المصدر").otherwise("more")))
    rows = p.join(shifted(1, "u1"), "page_id").join(shifted(2, "u2"), "page_id").select("page_id", "url", page.alias("html"))
    once = rows.groupBy("url").agg(F.count("*").alias("n"), F.min("page_id").alias("page_id"), F.min("html").alias("html")).where("n = 1")
    return discovery.publisher_link(once).join(once.select("url", "page_id"), "url").select("page_id", "link")


@query(f"""SELECT page_id AS feed, pos, title, source, link, published_at FROM (SELECT page_id, url, {_H1_SQL} AS t, {_HOST.format("url")} AS h FROM pages), LATERAL (VALUES
  (0, 'Report ' || page_id, h, url, TIMESTAMP '2024-03-01 10:20:00' + to_days((page_id % 28)::INT)), (1, 'Second & more', 'Post', 'https://guid.example/' || page_id, NULL)) n(pos, title, source, link, published_at)""")
def xml_items(spark, d):
    """The items of a feed of every page: one with its URL and a source, one with a guid and the source in its title."""
    text = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    number, host = F.col("page_id").cast("string"), urls.hostname(F.col("url"))
    stamp = F.date_format(F.date_add(F.lit("2024-03-01").cast("date"), (F.col("page_id") % 28).cast("int")), "dd MMM yyyy")
    first = text("<item><title>Report ", number, " - ", host, "</title><link>", F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), "</link><pubDate>Mon, ", stamp, ' 10:20:00 GMT</pubDate><source url="x">', host, "</source></item>")
    second = text("<item><title><![CDATA[Second &amp; more - Post]]></title><guid>https://guid.example/", number, "</guid></item>")
    feeds = Tables(spark, d).pages.select(F.col("page_id").alias("feed"), text("<rss>", first, second, "</rss>").alias("xml"))
    return html.feed_items(feeds).select("feed", "pos", "title", "source", "link", "published_at")
