"""What follows from fetched pages over several steps: sitemaps that name sitemaps, redirects that lead to redirects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.sources.shared_folder import discard, written

#: Sitemaps of one robots.txt that are read.
ROBOTS_MAPS = 3


def endpoints(sources: DataFrame, most: int = 6) -> DataFrame:
    """(source_id, url, endpoint): where the index of a source begins: its base URL, its hints, its robots.txt; the first ``most``, each once."""
    base = F.regexp_extract("base_url", "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    hint = lambda h: F.when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), h).otherwise(F.concat(base, F.when(h.startswith("/"), h).otherwise(F.concat(F.lit("/"), h))))
    hints = F.transform(F.coalesce("hints", F.array().cast("array<string>")), hint) if "hints" in sources.columns else F.array().cast("array<string>")
    every = F.slice(F.array_distinct(F.concat(F.array("base_url"), hints, F.array(F.concat(base, F.lit("/robots.txt"))))), 1, most)
    return sources.where(base != "").select("source_id", F.posexplode(every).alias("endpoint", "url")).select("source_id", "url", "endpoint")


def expand(bodies: DataFrame, roots: DataFrame) -> DataFrame:
    """(source_id, url, depth): all that is reached from the roots through robots.txt and sitemap indexes, over fetched (url, body).

    Semi-naive: a round follows only what the one before found first, so each body is read once a source and circles end;
    the rounds are as many as the deepest nesting. What was not fetched is reached, but leads nowhere.
    """
    loc = lambda block: F.trim(F.regexp_replace(F.regexp_extract(block, "(?is)<loc[^>]*>(.*?)</loc>", 1), "<!\\[CDATA\\[|\\]\\]>", ""))
    maps = F.slice(F.regexp_extract_all("body", F.lit("(?im)^\\s*sitemap:\\s*(\\S+)"), 1), 1, ROBOTS_MAPS)
    nested = F.transform(F.regexp_extract_all("body", F.lit("(?is)<sitemap>.*?</sitemap>"), 0), loc)
    links = F.when(urls.path(F.col("url")).endswith("/robots.txt"), maps).otherwise(nested)
    found = [written(roots.select("source_id", "url").where("url is not null").distinct().withColumn("depth", F.lit(0)), "frontier")]
    while True:
        named = found[-1].join(bodies.select("url", "body"), "url").select("source_id", F.explode(links).alias("url")).where(F.col("url") != "").distinct()
        for known in found:
            named = named.join(known.select("source_id", "url"), ["source_id", "url"], "left_anti")
        new = written(named.withColumn("depth", F.lit(len(found))), "frontier")
        if new.isEmpty():
            discard(new)
            break
        found.append(new)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def final_urls(edges: DataFrame, url: str = "url", target: str = "target") -> DataFrame:
    """(url, final, hops): where each redirecting URL ends; ``final`` is null for those that run in a circle.

    Pointer doubling: a round lets every open pointer jump to where its target points by now, so a chain of n redirects
    takes log2(n) rounds; what ended is set aside and only looked up. The number of open ones falls with every round as
    long as one of them has an end; when it doesn't, all are in or lead into a circle. Of several targets
    of one URL the least counts; a URL that redirects to itself is its own end.
    """
    start = edges.where(F.col(url).isNotNull() & F.col(target).isNotNull() & (F.col(url) != F.col(target)))
    pointers = written(start.groupBy(F.col(url).alias("url")).agg(F.min(target).alias("final"), F.lit(1).cast("bigint").alias("hops")), "pointers")
    still, done, left = pointers, [], pointers.count()
    while left:
        onward = still
        for part in done:
            onward = onward.unionByName(part)
        onward = onward.select(F.col("url").alias("final"), F.col("final").alias("_next"), F.col("hops").alias("_more"))
        moved = written(still.join(onward, "final", "left"), "pointers")
        discard(still)
        done.append(written(moved.where("_next is null").select("url", "final", "hops"), "ended"))
        still = written(moved.where("_next is not null").select("url", F.col("_next").alias("final"), (F.col("hops") + F.col("_more")).alias("hops")), "pointers")
        discard(moved)
        now = still.count()
        if now == left:
            break
        left = now
    every = still.select("url", F.lit(None).cast("string").alias("final"), F.lit(None).cast("bigint").alias("hops"))
    for part in done:
        every = every.unionByName(part)
    return every
