"""Titles and bodies of fetched pages: which are usable, how they are cleaned, which of several is taken, and repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.urls import hostname
from tidewire.sources import html

LEAST, MOST = 12, 320
_TURNS = "[\\x{200E}\\x{200F}\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}]"
# Titles that name a site or a section instead of a report.
GENERIC = ["^أخبار\\s+", "الأخبار العاجلة", "آخر الأخبار", "أخبار اليوم", "الرئيسية", "بوابة الأخبار", "موقع إخباري", "صحيفة إلكترونية", "^untitled$", "^no title$"]
# What publishers add to titles and bodies.
SITE, SITE_NAME, SITE_SLOGAN = "shafaq.com", "شفق نيوز", "آخر الأخبار العاجلة في العراق وكوردستان والعالم"
SLOGAN_END = "(?i)\\s*(?:[-–—|]\\s*)?(?:آخر الأخبار العاجلة|آخر الأخبار|الأخبار العاجلة)\\s+في\\s+العراق(?:\\s+وكوردستان)?(?:\\s+والعالم)?\\s*$"
BOILERPLATE = "(?i)حقوق النشر[^\\n]*|جميع الحقوق محفوظة[^\\n]*|اشترك في النشرة[^\\n]*|تابعنا على[^\\n]*"
BODY_CLASSES = (
    "article-body|article_body|articleBody|article-content|article_content|story-body|news-body|news_body|details-content|entry-content|post-content|content-body|field--name-body|news-details|article-text|article_txt"
)
ARTICLE_TYPE = "(?i)(?:NewsArticle|Article|ReportageNewsArticle)"


def plain(title: Column) -> Column:
    """A title without tags, entities and marks of direction."""
    return F.trim(F.regexp_replace(F.regexp_replace(html.decode_entities(html.strip_tags(F.regexp_replace(F.coalesce(title, F.lit("")), "(?i)&(?:lrm|rlm);|&#(?:8206|8207|x200e|x200f);", " "))), _TURNS, " "), "\\s+", " "))


def usable(title: Column) -> Column:
    """Long enough and not too long, in Arabic, no address, no name of a site or section."""
    t = plain(title)
    generic = F.lit(False)
    for pattern in GENERIC:
        generic = generic | t.rlike(f"(?i){pattern}")
    return t.rlike("[\\x{0600}-\\x{06FF}]") & F.length(t).between(LEAST, MOST) & ~t.rlike("^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$") & ~t.rlike("(?i)^(?:https?://|www\\.)\\S+$") & ~generic


def cleaned(title: Column, url: Column) -> Column:
    """A title without what its publisher adds."""
    t, host = plain(title), hostname(F.coalesce(url, F.lit("")))
    site = F.trim(F.regexp_replace(F.regexp_replace(t, f"(?is)\\s*(?:[-–—|]\\s*)?{SITE_NAME}(?:\\s*\\|.*)?$", ""), f"(?is)\\s*\\|\\s*{SITE_SLOGAN}.*$", ""))
    t = F.when((host == SITE) | host.endswith(f".{SITE}"), site).otherwise(t)
    return F.trim(F.regexp_replace(F.regexp_replace(t, SLOGAN_END, ""), "\\s+", " "))


def _headline(nodes: Column) -> Column:
    """The first headline, or else name, of the nodes that are articles or of no type."""
    told = F.filter(nodes, lambda n: (F.coalesce(n["type"], F.lit("")) == "") | n["type"].rlike(ARTICLE_TYPE))
    names = F.filter(F.transform(told, lambda n: F.coalesce(F.nullif(plain(n["headline"]), F.lit("")), plain(n["name"]))), lambda t: t != "")
    return F.coalesce(F.get(names, 0), F.lit(""))


def elected(page: Column, fallback: Column, url: Column) -> Column:
    """The first of the page's names that is left after cleaning: JSON-LD, heading, metadata, then the fallback."""
    options = F.array(*(cleaned(c, url) for c in (_headline(html.json_ld(page)), html.heading(page), html.meta(page, "og:title"), html.meta(page, "twitter:title"), fallback)))
    return F.coalesce(F.get(F.filter(options, lambda t: t != ""), 0), F.lit(""))


def repaired(articles: DataFrame, title: str = "title", page: str = "html") -> DataFrame:
    """``articles`` with unusable titles replaced by the first usable one of their own page; ``method`` says from where.

    Row by row: each article is repaired from its own page, also where rows share a URL. A null page repairs nothing.
    """
    headings = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit("(?is)<h1\\b[^>]*>(.*?)</h1>"), 1)
    longest = F.array_max(F.transform(F.filter(F.transform(headings, plain), usable), lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("order"), t.alias("t"))))["t"]
    read = articles.withColumns({"_node": F.when(F.col(page).isNotNull(), _headline(html.json_ld(F.col(page)))), "_h1": longest, "_og": plain(html.meta(F.col(page), "og:title")), "_tw": plain(html.meta(F.col(page), "twitter:title"))})
    option = lambda name, c: F.when(F.coalesce(usable(F.col(c)), F.lit(False)), F.struct(F.col(c).alias("title"), F.lit(name).alias("method")))
    best = F.coalesce(*(option(n, c) for n, c in (("JSON_LD_HEADLINE", "_node"), ("ARTICLE_H1", "_h1"), ("OG_TITLE", "_og"), ("TWITTER_TITLE", "_tw"))))
    found = read.withColumn("_best", F.when(~F.coalesce(usable(F.col(title)), F.lit(False)), best))
    found = found.withColumn("_best", F.when(F.col("_best.title") != F.coalesce(title, F.lit("")), F.col("_best")))
    return found.withColumns({title: F.coalesce("_best.title", title), "method": F.col("_best.method")}).drop("_node", "_h1", "_og", "_tw", "_best")


def clean_body(text: Column) -> Column:
    """A body without tags, slogans, notices of rights and calls to subscribe."""
    t = html.decode_entities(html.strip_blocks(F.coalesce(text, F.lit(""))))
    t = F.regexp_replace(F.regexp_replace(t, f"(?i){SITE_NAME}\\s*\\|\\s*{SITE_SLOGAN}|{SITE_SLOGAN}", " "), BOILERPLATE, " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[ \\t]+", " "), "\\n\\s*\\n+", "\n\n"), "^\\s+|\\s+$", "")


def best_body(page: Column) -> Column:
    """The longest clean text of a page's JSON-LD, its article, main and body blocks, and its descriptions; the first among equals."""
    nodes = F.flatten(F.transform(html.json_ld(page), lambda n: F.array(n["article_body"], n["text"], n["description"])))
    blocks = [F.regexp_extract_all(page, F.lit(p), 1) for p in ("(?is)<article\\b[^>]*>(.*?)</article>", "(?is)<main\\b[^>]*>(.*?)</main>", f"(?is)<(?:div|section)[^>]+(?:id|class)=[\"'][^\"']*(?:{BODY_CLASSES})[^\"']*[\"'][^>]*>(.*?)</(?:div|section)>")]
    every = F.concat(nodes, *blocks, F.array(html.meta(page, "og:description"), html.meta(page, "description")))
    ranked = F.transform(F.transform(every, clean_body), lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("order"), t.alias("text")))
    return F.coalesce(F.array_max(ranked)["text"], F.lit(""))
