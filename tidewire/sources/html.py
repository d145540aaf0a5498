"""What fetched pages and feeds hold, as columns: titles, metadata, links, bodies, feed items."""

from __future__ import annotations

import json
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.text import BLANKS
from tidewire.functions.urls import hostname
from tidewire.sources.shared_folder import written

# The named entities of news pages.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


@F.pandas_udf(T.StringType())
def _numeric(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or "&#" not in v else unescape(v))


def decode_entities(text: Column, numeric: bool = False) -> Column:
    """Named entities; ``numeric`` decodes numbered ones too, in Arrow batches."""
    if numeric:
        text = _numeric(text)
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def strip_tags(html: Column) -> Column:
    """Text without scripts, styles, comments and tags, blanks collapsed."""
    bare = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), BLANKS, " "))


def strip_blocks(html: Column) -> Column:
    """As above with a line for every block."""
    bare = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    lines = F.regexp_replace(F.regexp_replace(bare, "(?i)<br\\s*/?>|</(?:p|div|li|h[1-6]|article|section)>", "\n"), "<[^>]*>", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lines, "[ \\t]+", " "), "\\s*\\n\\s*", "\n"), "^\\s+|\\s+$", "")


def title(html: Column) -> Column:
    return decode_entities(strip_tags(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)))


def heading(html: Column) -> Column:
    return decode_entities(strip_tags(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1)))


def meta(html: Column, key: str) -> Column:
    """Content of a meta element by name or property, the attributes in either order; null if absent."""
    k = key.replace(".", "\\.")
    first = F.regexp_extract(html, f"(?is)<meta[^>]+(?:name|property)=[\"']{k}[\"'][^>]*content=[\"']([^\"']*)[\"']", 1)
    second = F.regexp_extract(html, f"(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]*(?:name|property)=[\"']{k}[\"']", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")))


def canonical_link(html: Column, fallback: Column) -> Column:
    link = F.regexp_extract(html, "(?is)<link[^>]+rel=[\"']canonical[\"'][^>]*href=[\"']([^\"']*)[\"']", 1)
    return F.coalesce(F.nullif(link, F.lit("")), meta(html, "og:url"), fallback)


def best_text(html: Column) -> Column:
    """The longest of the article, main and body-like blocks and the descriptions, as text."""
    blocks = F.regexp_extract_all(html, F.lit("(?is)<(?:article|main)[^>]*>(.*?)</(?:article|main)>"), 1)
    found = F.concat(F.transform(blocks, strip_tags), F.array(*(F.coalesce(meta(html, k), F.lit("")) for k in ("description", "og:description"))))
    ranked = F.transform(found, lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("order"), t.alias("text")))
    return F.coalesce(decode_entities(F.array_max(ranked)["text"]), F.lit(""))


def links(pages: DataFrame, url: str = "url", html: str = "html", least_text: int = 1, keep: str | None = None) -> DataFrame:
    """(url, pos, href, text, link, host) of every anchor with so much text, with a column to keep; the link is resolved against the page."""
    anchors = F.regexp_extract_all(html, F.lit("(?is)<a\\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>.*?</a>"), 1)
    texts = F.regexp_extract_all(html, F.lit("(?is)<a\\s[^>]*href=[\"'][^\"']*[\"'][^>]*>(.*?)</a>"), 1)
    own = [keep] if keep else []
    rows = pages.select(F.col(url).alias("url"), *own, F.posexplode(F.arrays_zip(anchors.alias("href"), texts.alias("text"))).alias("pos", "a"))
    rows = rows.select("url", *own, "pos", F.col("a.href").alias("href"), strip_tags(F.col("a.text")).alias("text")).where(F.length("text") >= least_text)
    base = F.regexp_extract("url", "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract("url", "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    folder = F.regexp_extract("url", "^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)", 1)
    resolved = (
        F.when(F.col("href").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("href"))
        .when(F.col("href").startswith("//"), F.concat(scheme, F.col("href")))
        .when(F.col("href").startswith("/"), F.concat(base, F.col("href")))
        .otherwise(F.concat(folder, F.col("href")))
    )
    return rows.withColumn("link", resolved).withColumn("host", hostname(F.col("link")))


def feed_items(feeds: DataFrame, key: str = "feed", xml: str = "xml", most: int = 30) -> DataFrame:
    """Items of RSS feeds: the first ``most`` of each, with " - source" taken off the title; the source falls back to it."""
    items = F.slice(F.regexp_extract_all(xml, F.lit("(?is)<item>(.*?)</item>"), 1), 1, most)
    rows = feeds.select(F.col(key).alias("feed"), F.posexplode(items).alias("pos", "item"))
    tag = lambda name: decode_entities(strip_tags(F.regexp_replace(F.regexp_extract("item", f"(?is)<{name}[^>]*>(.*?)</{name}>", 1), "<!\\[CDATA\\[|\\]\\]>", "")))
    given, raw = tag("source"), tag("title")
    source = F.when(given != "", given).otherwise(F.regexp_extract(raw, "^.* - ([^-]+)$", 1))
    bare = F.when((source != "") & raw.endswith(F.concat(F.lit(" - "), source)), F.expr("''")).otherwise(F.lit(None))
    trimmed = F.when(bare.isNotNull(), F.left(raw, F.length(raw) - F.length(source) - 3)).otherwise(raw)
    published = F.try_to_timestamp(F.regexp_replace(tag("pubDate"), "^[A-Za-z]{3},\\s*", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    link = tag("link")
    return rows.select("feed", "pos", trimmed.alias("title"), source.alias("source"), F.coalesce(F.nullif(link, F.lit("")), tag("guid")).alias("link"), published.alias("published_at"), tag("description").alias("description"))


_NODE = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "headline", "name", "article_body", "text", "description", "url")])


@F.pandas_udf(T.ArrayType(_NODE))
def json_ld(html: pd.Series) -> pd.Series:
    """Every object of all ld+json scripts, at any depth; scripts that don't parse are skipped. Arrow batches: the depth is open."""
    import re

    scripts = re.compile(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>")

    def nodes(value):
        if isinstance(value, list):
            for v in value:
                yield from nodes(v)
        elif isinstance(value, dict):
            yield value
            for v in value.values():
                yield from nodes(v)

    def of(page):
        found = []
        for script in scripts.findall(page or ""):
            try:
                found += list(nodes(json.loads(script)))
            except ValueError:
                continue
        text = lambda n, k: n.get(k) if isinstance(n.get(k), str) else None
        kind = lambda n: " ".join(map(str, n["@type"])) if isinstance(n.get("@type"), list) else text(n, "@type")
        names = {"headline": "headline", "name": "name", "article_body": "articleBody", "text": "text", "description": "description", "url": "url"}
        return [{"type": kind(n), **{c: text(n, k) for c, k in names.items()}} for n in found]

    return html.map(of)


def json_ld_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, script, path, type, headline, name, article_body, url) of every object of a page's ld+json scripts, at any depth, in the JVM.

    Scripts become VARIANT values, opened level by level until a level holds no object or array; the rounds are as many
    as the deepest nesting, and each opens what the one before found. Scripts that don't parse give nothing; a path is
    that of the object in its script, from "$" on. Of several types all are named, a blank between.
    """
    scripts = F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), 1))
    parsed = pages.select(F.col(key).alias("key"), scripts.alias("script", "json")).select("key", "script", F.lit("$").alias("path"), F.try_parse_json("json").alias("v"))
    nested = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)<")
    levels = [written(parsed.where(F.col("v").isNotNull()).where(nested), "json-ld")]
    while not levels[-1].isEmpty():
        opened = levels[-1].lateralJoin(levels[-1].sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("_pos", "_key", "_value"))
        step = F.when(F.col("_key").isNotNull(), F.concat(F.lit("."), "_key")).otherwise(F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))
        levels.append(written(opened.select("key", "script", F.concat("path", step).alias("path"), F.col("_value").alias("v")).where(nested), "json-ld"))
    every = levels[0]
    for more in levels[1:-1]:
        every = every.unionByName(more)
    text = lambda name: F.when(F.schema_of_variant(F.try_variant_get("v", f"$.{name}", "variant")) == "STRING", F.try_variant_get("v", f"$.{name}", "string"))
    kinds = F.coalesce(F.array_join(F.try_variant_get("v", '$["@type"]', "array<string>"), " "), F.try_variant_get("v", '$["@type"]', "string"))
    objects = every.where(F.schema_of_variant("v").startswith("OBJECT"))
    return objects.select(F.col("key").alias(key), "script", "path", kinds.alias("type"), text("headline").alias("headline"), text("name").alias("name"), text("articleBody").alias("article_body"), text("url").alias("url"))


def embedded_url(token: Column) -> Column:
    """The URL inside a URL-safe base64 token of a redirect link; "" if there is none."""
    padded = F.rpad(F.translate(token, "-_", "+/"), (F.ceil(F.length(token) / 4) * 4).cast("int"), F.lit("="))
    return F.regexp_extract(F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1"), "(https?://[\\x21-\\x7E]+)", 1)


def redirect_candidates(html: Column) -> Column:
    """URLs a redirect page points to: data attribute, canonical, og:url, meta refresh; distinct, in that order."""
    patterns = ("data-n-au=[\"']([^\"']+)[\"']", "<link[^>]+rel=[\"']canonical[\"'][^>]*href=[\"']([^\"']+)[\"']", "<meta[^>]+property=[\"']og:url[\"'][^>]*content=[\"']([^\"']+)[\"']", "http-equiv=[\"']refresh[\"'][^>]*url=([^\"'>]+)")
    return F.array_distinct(F.concat(*(F.regexp_extract_all(html, F.lit(f"(?is){p}"), 1) for p in patterns)))


def batch_url(answer: Column) -> Column:
    """The URL in a redirect service's answer: the one it names as resolved, else the first there is; "" if there is none."""
    named = F.regexp_extract(answer, r'\[\\"garturlres\\",\\"(.*?)\\",', 1)
    first = F.regexp_extract(answer, r'(?i)(https?:\\?/?\\?/[^"\\\s]+)', 1)
    url = F.coalesce(F.nullif(named, F.lit("")), first)
    for code, char in (("/", "/"), ("u003d", "="), ("u0026", "&"), ("u003f", "?")):
        url = F.regexp_replace(url, r"\\+" + code, char)
    return F.when(url.rlike("(?i)^https?://[^/\\s]"), url).otherwise("")
