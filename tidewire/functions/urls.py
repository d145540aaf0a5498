"""URL canonicalisation, hosts and policies as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only track.
TRACKING = ("utm_[^=&]*", "fbclid[^=&]*", "gclid[^=&]*", "mc_[^=&]*")
_URL = "^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?"


def canonical(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Lower-cased scheme and host, no default port, no fragment, no tracking parameters; "" if it is no URL."""
    part = lambda i: F.regexp_extract(url, _URL, i)
    host = F.regexp_replace(F.lower(part(2)), "^([^:]*):(80|443)$", "$1")
    query = part(4)
    if tracking:
        query = F.regexp_replace(F.concat(F.lit("&"), query), f"&(?:{'|'.join(tracking)})(?:=[^&]*)?(?=&|$)", "")
        query = F.regexp_replace(query, "^&+", "")
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    return F.when(part(2) == "", F.lit("")).otherwise(F.concat(F.lower(part(1)), F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def hostname(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), "^www\\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def article_like(url: Column, least_path: int = 5) -> Column:
    """A path of some length with a long number or several parts."""
    p = path(url)
    return (F.length(p) >= least_path) & (p.rlike("[0-9]{4,}") | p.rlike("/[^/]+/[^/]+"))


def under(host: Column, domains: list[str]) -> Column:
    """The host is one of the domains or below one."""
    found = F.lit(False)
    for d in domains:
        found = found | (host == d) | host.endswith("." + d)
    return found


def forbidden(url: Column, domains: list[str], exempt: Column | None = None) -> Column:
    """An empty host, or one of the domains, unless the row is exempt."""
    host = hostname(url)
    bad = (host == "") | under(host, domains)
    return F.coalesce(bad, F.lit(True)) & ~F.coalesce(exempt if exempt is not None else F.lit(False), F.lit(False))


def aggregator_exempt(url: Column, flag: Column, source_id: Column, method: Column, host: str, sources: list[str], methods: list[str]) -> Column:
    """All five must hold: host, an article's path, the flag, the source and how it was found."""
    return (hostname(url) == host) & path(url).rlike("^/articles/[0-9]+/?$") & F.coalesce(flag, F.lit(False)) & source_id.isin(*sources) & method.isin(*methods)


def candidate_score(url: Column) -> Column:
    """How much a URL looks like an article's."""
    p = path(url)
    return p.rlike("[0-9]{4,}").cast("int") * 20 + p.rlike("(?i)/(news|article|story|details?|politics|economy|iraq|local)/").cast("int") * 15 + p.rlike("/[^/]+/[^/]+").cast("int") * 10 + F.least(F.length(p), F.lit(100)) / 25


def best_candidate(urls: Column, least: int = 20) -> Column:
    """The highest-scored URL of an array, the first among equals; null below ``least``."""
    scored = F.transform(urls, lambda u, i: F.struct(candidate_score(u).alias("score"), (-i).alias("order"), u.alias("url")))
    best = F.array_max(F.filter(scored, lambda s: s["score"] >= least))
    return best["url"]
