"""Rules for found reports: what is rejected, which source an item belongs to, what indexes and pages offer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.functions.lexicon import any_of
from tidewire.functions.text import normalize
from tidewire.operators.profiles import normed
from tidewire.sources import html

# Words of ceremony, of which no report is taken.
CEREMONIAL = ["تهنئة", "تعزية", "برقية تهنئة", "برقية تعزية", "استقبال المهنئين", "ذكرى تأسيس", "حفل تكريم"]
# Hosts of social networks as looked for in a source's name and homepage.
SOCIAL = "facebook\\.com|instagram\\.com|youtube\\.com|twitter\\.com|(^|\\s)x\\.com|tiktok\\.com"
# Hosts that are no publisher's, and those that end in one of the names.
NO_PUBLISHER = "(^|\\.)google\\.[a-z.]+$|(gstatic|googleusercontent|facebook|instagram|youtube|twitter|tiktok)\\.com$|(^|\\.)x\\.com$|(w3|schema|xmlsoft)\\.org$"
# Folders and file types that are no article's.
NO_ARTICLE = {
    "recover": ("(?i)\\.(?:jpg|jpeg|png|gif|webp|svg|ico|css|js|pdf|zip|mp4|mp3)$", "(?i)/(?:tag|tags|category|categories|section|author|login|privacy|about|contact|feed|rss)(?:/|$)"),
    "resolve": ("(?i)\\.(?:jpg|jpeg|png|gif|webp|svg|ico|css|js|pdf|zip|mp4|mp3)$", "(?i)/(?:search|tag|tags|category|categories|section|author|login|privacy|about|contact|feed|rss)(?:/|$)|(?i)/XML/|/namespace|/schema\\b"),
    "priority": ("(?i)\\.(?:jpg|png|pdf|mp4)$", "(?i)/(?:feed|rss|category|tag|author)(?:/|$)"),
}
# What a link to the full report says, normalised.
SOURCE_LINK = "المصدر|الخبر كاملا|اقرا الخبر"


def ceremonial(title: Column, description: Column, excluded: Column) -> Column:
    """A word of ceremony, or one the keyword excludes, in title or description."""
    text = normalize(F.concat_ws("\n", title, description), "plain")
    own = F.exists(F.coalesce(excluded, F.array().cast("array<string>")), lambda t: (normalize(t, "plain") != "") & F.contains(text, normalize(t, "plain")))
    return any_of(text, normed(CEREMONIAL, "plain")) | F.coalesce(own, F.lit(False))


def social(homepage: Column, name: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(homepage, F.lit("")), F.coalesce(name, F.lit("")))).rlike(SOCIAL)


def recent(raw: Column, ts: Column, as_of: Column, days: int) -> Column:
    """An empty date passes, an unreadable one doesn't."""
    return (F.coalesce(raw, F.lit("")) == "") | F.coalesce(ts >= as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))


def no_publisher(url: Column) -> Column:
    host = urls.hostname(url)
    return (F.coalesce(host, F.lit("")) == "") | host.rlike(NO_PUBLISHER)


def article_like(url: Column, kind: str = "recover", least_path: int = 2) -> Column:
    """A web page that may be an article by its path. ``priority`` wants a long number or two parts, ``resolve`` five characters."""
    p = urls.path(url) if kind == "priority" else F.coalesce(F.try_url_decode(urls.path(url)), F.lit(""))
    files, folders = NO_ARTICLE[kind]
    fine = url.rlike("^(?i)https?://[^/?#]") & (F.length(p) >= (5 if kind == "resolve" else least_path)) & ~p.rlike(files) & ~p.rlike(folders)
    if kind == "priority":
        fine = fine & (p.rlike("[0-9]{4,}") | (F.size(F.filter(F.split(p, "/"), lambda x: x != "")) >= 2))
    return F.coalesce(fine, F.lit(False))


def own(url: Column, hosts: Column, prefix: Column) -> Column:
    """The host is one of the source's or below one, and the path begins as the source's do."""
    host = urls.hostname(url)
    at = F.exists(hosts, lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h)))
    return F.coalesce(at & ((F.coalesce(prefix, F.lit("")) == "") | urls.path(url).startswith(prefix)), F.lit(False))


def index_items(bodies: DataFrame, kind: str = "recover", least_text: int = 18) -> DataFrame:
    """(source_id, endpoint, pos, title, url, date, method) of what feeds, sitemaps and listings of a source offer.

    ``bodies``: source_id, endpoint (its place among the source's), url, body, hosts. Feeds need a title, listings one of
    ``least_text`` characters and a link to one of the source's hosts; every link must be article-like.
    """
    tag = lambda block, name: F.regexp_extract(block, f"(?is)<{name}[^>]*>(.*?)</{name}>", 1)
    text = lambda c: html.decode_entities(html.strip_tags(F.regexp_replace(c, "<!\\[CDATA\\[|\\]\\]>", "")))
    link = lambda c: urls.canonical(F.trim(html.decode_entities(F.regexp_replace(c, "<!\\[CDATA\\[|\\]\\]>", ""))))
    struct = lambda title, url, date, method: F.struct(title.alias("title"), url.alias("url"), date.alias("date"), F.lit(method).alias("method"))
    first = lambda *options: F.coalesce(*(F.nullif(o, F.lit("")) for o in options), F.lit(""))

    def feed(block: Column) -> Column:
        href = F.regexp_extract(block, "(?is)<link[^>]+href=[\"']([^\"']+)[\"']", 1)
        return struct(text(tag(block, "title")), link(first(href, tag(block, "link"), tag(block, "guid"))), text(first(tag(block, "pubDate"), tag(block, "published"), tag(block, "updated"))), "feed")

    site = lambda block: struct(text(first(tag(block, "news:title"), tag(block, "title"))), link(tag(block, "loc")), text(tag(block, "lastmod")), "sitemap")
    blocks = F.concat(F.transform(F.regexp_extract_all("body", F.lit("(?is)<(?:item|entry)>.*?</(?:item|entry)>"), 0), feed), F.transform(F.regexp_extract_all("body", F.lit("(?is)<url>.*?</url>"), 0), site))
    told = bodies.select("source_id", "endpoint", F.posexplode(blocks).alias("pos", "i")).select("source_id", "endpoint", "pos", "i.*")
    told = told.where(((F.col("method") != "feed") | (F.col("title") != "")) & article_like(F.col("url"), kind))
    listed = html.links(bodies.withColumn("page", F.struct("source_id", "endpoint", "hosts", F.col("url").alias("at"))).select(F.col("url"), "body", "page"), "url", "body", least_text, keep="page")
    listed = listed.where(own(F.col("link"), F.col("page.hosts"), F.lit("")) & article_like(F.col("link"), kind))
    return told.unionByName(listed.select("page.source_id", "page.endpoint", (F.col("pos") + 1_000_000).alias("pos"), html.decode_entities(F.col("text")).alias("title"), urls.canonical(F.col("link")).alias("url"), F.lit("").alias("date"), F.lit("listing").alias("method")))


def source_index(items: DataFrame, endpoints: int = 6, most: int = 1_200) -> DataFrame:
    """The items of a source's first ``endpoints``, the first of each URL, at most ``most`` of a source: the caps bound an index."""
    early = items.where(F.col("endpoint") < endpoints)
    once = early.groupBy("source_id", "url").agg(F.min_by(F.struct("endpoint", "pos", "title", "method"), F.struct("endpoint", "pos")).alias("i"))
    place = F.row_number().over(Window.partitionBy("source_id").orderBy("i.endpoint", "i.pos"))
    return once.withColumn("place", place).where(F.col("place") <= most).select("source_id", "place", "url", "i.title", "i.method")


def belongs(homepage: Column, named: Column, hosts: Column, names: Column) -> Column:
    """The homepage's host equals one of the source's or one is below the other; or a name of the source is in the text."""
    host = urls.hostname(homepage)
    at = (host != "") & F.exists(hosts, lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h)) | h.endswith(F.concat(F.lit("."), host)))
    text = normalize(named, "index")
    return F.coalesce(at, F.lit(False)) | F.coalesce(F.exists(names, lambda n: (n != "") & F.contains(text, normalize(n, "index"))), F.lit(False))


def recovered(items: DataFrame, sources: DataFrame, index: DataFrame, threshold: float = 0.54) -> DataFrame:
    """(item_id, source_id, url, similarity): each item's most similar title among the index entries of its sources.

    ``items``: item_id, homepage, source, title; ``sources``: source_id, hosts, names, a short list by nature and joined
    by broadcast, as a condition that is no equality would read all items again for each part of it; ``index``: source_id, place, url, title. The first entry wins among equals.

    Items of one source share words, and a source may have most of the items: those of one word are dealt to as many
    tasks as a shuffle has, each with the entries of the word. Tokens are counted where they meet; no title goes along.
    """
    from tidewire.functions.text import tokens

    shares = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = belongs(F.col("homepage"), F.concat_ws(" ", "source", "title"), F.col("hosts"), F.col("names"))
    at = items.join(F.broadcast(sources.select("source_id", "hosts", "names")), fits).select("item_id", "source_id", tokens(F.col("title"), profile="index").alias("t"))
    entries = index.select("source_id", "place", "url", tokens(F.col("title"), profile="index").alias("e"))
    # Blocked by source and token: entries that share no word score nothing.
    at = at.withColumn("row", F.monotonically_increasing_id())
    x = at.select("row", "item_id", "source_id", F.size("t").alias("n"), F.explode("t").alias("w")).withColumn("share", F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int"))
    y = entries.select("source_id", "place", "url", F.size("e").alias("m"), F.explode("e").alias("w")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    met = x.join(y, ["source_id", "w", "share"]).groupBy("row", "item_id", "source_id", "place", "url", "n", "m").agg(F.count("*").alias("both"))
    similarity = F.floor((0.7 * (F.col("both") / F.least("n", "m")) + 0.3 * (F.col("both") / (F.col("n") + F.col("m") - F.col("both")))) * 10_000 + 0.5) / 10_000
    scored = met.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    best = scored.groupBy("item_id").agg(F.max_by(F.struct("source_id", "url", "similarity"), F.struct("similarity", (-F.col("place")).alias("p"))).alias("b"))
    return best.select("item_id", "b.source_id", "b.url", "b.similarity")


def page_info(page: Column, fallback: Column) -> dict[str, Column]:
    """Title, date, description and canonical URL of a fetched page, each from the first place that has one."""
    first = lambda *options: F.coalesce(*(F.nullif(o, F.lit("")) for o in options))
    strip = lambda c: html.decode_entities(html.strip_tags(c))
    return {
        "title": first(html.heading(page), strip(html.meta(page, "og:title")), strip(html.meta(page, "twitter:title"))),
        "date": F.try_to_timestamp(first(html.meta(page, "article:published_time"), F.regexp_extract(page, "(?is)<time[^>]+datetime=[\"']([^\"']+)[\"']", 1))),
        "description": first(strip(html.meta(page, "og:description")), strip(html.meta(page, "description"))),
        "canonical": urls.canonical(html.canonical_link(page, fallback), urls.TRACKING[:3]),
    }


def publisher_link(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(url, link): an aggregator page's link to the publisher: not its own, not forbidden, article-like; one that says so first."""
    found = html.links(pages, url, page, least_text=0)
    outside = found.where((F.col("host") != urls.hostname(F.col("url"))) & ~F.col("host").endswith(F.concat(F.lit("."), urls.hostname(F.col("url")))) & ~no_publisher(F.col("link")) & article_like(F.col("link"), "priority"))
    says = normalize(F.col("text"), "origin").rlike(SOURCE_LINK).cast("int")
    best = outside.groupBy("url").agg(F.max_by("link", F.struct(says, -F.col("pos"))).alias("link"))
    return best.select("url", urls.canonical(F.col("link"), urls.TRACKING[:3]).alias("link"))
