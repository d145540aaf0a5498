"""Queries over what pages lead to in several steps; what was fetched is derived from the table of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import crawl, discovery
from tidewire.plans.page_queries import _CANONICAL, _HOST
from tidewire.plans.registry import Tables, query

_MAPS, _LEAF, _INNER = 4, 40, 1_600


def fetched_maps(pages):
    """(url, body): for every host a robots.txt of four sitemaps, their indexes two deep, and maps of at most 40 pages; an inner index names the first sitemap again."""
    host = urls.hostname(F.col("url"))
    p = pages.where(host != "").select(host.alias("host"), "url", "page_id", F.floor(F.col("page_id") / _LEAF).alias("leaf"), F.floor(F.col("page_id") / _INNER).alias("inner"))
    at = lambda kind, *n: F.concat(F.lit("https://"), "host", F.lit(f"/{kind}"), *(F.concat(F.lit("-"), x.cast("string")) for x in n), F.lit(".xml"))
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    entry = F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc><news:title>Page "), F.col("page_id").cast("string"), F.lit("</news:title></url>"))
    joined = lambda c: F.array_join(F.collect_list(c), "")
    names = lambda c: F.concat(F.lit("<sitemap><loc>"), c, F.lit("</loc></sitemap>"))
    leaves = p.groupBy("host", "leaf").agg(joined(entry).alias("b")).select(at("maps/leaf", F.col("leaf")).alias("url"), F.concat(F.lit("<urlset>"), "b", F.lit("</urlset>")).alias("body"))
    inner = p.select("host", "leaf", "inner").distinct().groupBy("host", "inner").agg(joined(names(at("maps/leaf", F.col("leaf")))).alias("b"))
    inner = inner.select(at("maps/inner", F.col("inner")).alias("url"), F.concat(F.lit("<sitemapindex>"), "b", names(at("sitemap", F.lit(0))), F.lit("</sitemapindex>")).alias("body"))
    tops = p.select("host", "inner", F.pmod("inner", F.lit(_MAPS)).alias("top")).distinct().groupBy("host", "top").agg(joined(names(at("maps/inner", F.col("inner")))).alias("b"))
    tops = tops.select(at("sitemap", F.col("top")).alias("url"), F.concat(F.lit("<sitemapindex>"), "b", F.lit("</sitemapindex>")).alias("body"))
    lines = F.concat(F.lit("User-agent: *\n"), *(F.concat(F.lit("Sitemap: "), at("sitemap", F.lit(i)), F.lit("\n")) for i in range(_MAPS)))
    robots = p.select("host").distinct().select(F.concat(F.lit("https://"), "host", F.lit("/robots.txt")).alias("url"), lines.alias("body"))
    return leaves.unionByName(inner).unionByName(tops).unionByName(robots)


@query(f"""SELECT host AS source_id, url, min(page_id) AS page_id FROM (SELECT {_HOST.format("url")} AS host, {_CANONICAL} AS url, page_id FROM pages) WHERE host <> '' AND (page_id // {_INNER}) % {_MAPS} < 3 GROUP BY ALL""")
def sitemap_index(spark, d):
    """What every host's robots.txt leads to, through two levels of indexes: the pages of its first three sitemaps, by canonical URL."""
    pages = Tables(spark, d).pages
    bodies = fetched_maps(pages)
    sources = pages.select(urls.hostname(F.col("url")).alias("source_id")).where("source_id <> ''").distinct().withColumn("base_url", F.concat(F.lit("https://"), "source_id", F.lit("/")))
    reached = crawl.expand(bodies, crawl.endpoints(sources))
    read = bodies.join(reached, "url").select("source_id", F.col("depth").alias("endpoint"), "url", "body", F.array("source_id").alias("hosts"))
    items = discovery.index_items(read).select("source_id", "url", F.regexp_extract("title", "[0-9]+", 0).cast("bigint").alias("page_id"))
    return items.groupBy("source_id", "url").agg(F.min("page_id").alias("page_id"))


_BLOCK = 16


@query(f"""WITH RECURSIVE moved AS (
  SELECT p.page_id, p.url, t.url AS target FROM pages p JOIN pages t ON t.page_id = CASE WHEN p.page_id % {_BLOCK} > 0 THEN p.page_id - 1 WHEN (p.page_id // {_BLOCK}) % 5 = 0 THEN p.page_id + {_BLOCK - 1} END WHERE p.url <> t.url
), edges AS (SELECT url, min(target) AS target FROM moved GROUP BY url),
walk AS (SELECT url, target, 1 AS hops FROM edges UNION ALL SELECT w.url, e.target, w.hops + 1 FROM walk w JOIN edges e ON w.target = e.url WHERE w.hops < 300)
SELECT url, CASE WHEN max(hops) < 300 THEN max_by(target, hops) END AS final, CASE WHEN max(hops) < 300 THEN max(hops) END::BIGINT AS hops FROM walk GROUP BY url""")
def redirect_chains(spark, d):
    """Pages that redirect to the page before them, in blocks of 16 of which every fifth runs in a circle: where each URL ends."""
    p = Tables(spark, d).pages.select("page_id", "url")
    back = F.when(F.col("page_id") % _BLOCK > 0, F.col("page_id") - 1).when(F.floor(F.col("page_id") / _BLOCK) % 5 == 0, F.col("page_id") + (_BLOCK - 1))
    to = p.select(F.col("page_id").alias("to"), F.col("url").alias("target"))
    return crawl.final_urls(p.withColumn("to", back).join(to, "to").select("url", "target"))
