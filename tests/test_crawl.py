"""Sitemap indexes to their fixpoint, redirects to their ends, search over members, components from run to run."""

import random

from pyspark.sql import functions as F

from tidewire.operators import components, crawl, search


def test_expand_follows_robots_and_indexes(spark):
    index = lambda *to: "<sitemapindex>" + "".join(f"<sitemap><loc> {t} </loc></sitemap>" for t in to) + "</sitemapindex>"
    bodies = [
        ("https://a.example/robots.txt", "User-agent: *\nsitemap: https://a.example/1.xml\nSitemap: https://a.example/2.xml\nSITEMAP:https://a.example/3.xml\nSitemap: https://a.example/4.xml"),
        ("https://a.example/1.xml", index("https://a.example/deep.xml", "https://a.example/2.xml")), ("https://a.example/deep.xml", index("https://a.example/1.xml", "https://a.example/deeper.xml")),
        ("https://a.example/2.xml", "<urlset><url><loc>https://a.example/page</loc></url></urlset>"), ("https://b.example/", "Sitemap: https://b.example/not-robots.xml"), ("https://b.example/robots.txt", None),
    ]
    sources = spark.createDataFrame([("a", "https://a.example/", ["rss", "/x.xml", "https://f.example/feed"]), ("b", "https://b.example/", None), ("c", "no url", None)], "source_id string, base_url string, hints array<string>")
    roots = crawl.endpoints(sources)
    assert [r.url for r in roots.where("source_id = 'a'").orderBy("endpoint").collect()] == ["https://a.example/", "https://a.example/rss", "https://a.example/x.xml", "https://f.example/feed", "https://a.example/robots.txt"]
    assert crawl.endpoints(sources, 2).count() == 4
    reached = {(r.source_id, r.url): r.depth for r in crawl.expand(spark.createDataFrame(bodies, "url string, body string"), roots).collect()}
    assert {u.rpartition("/")[2]: n for (s, u), n in reached.items() if s == "a" and n} == {"1.xml": 1, "2.xml": 1, "3.xml": 1, "deep.xml": 2, "deeper.xml": 3}
    assert sorted(u for s, u in reached if s == "b") == ["https://b.example/", "https://b.example/robots.txt"]
    none = spark.createDataFrame([], "url string, body string")
    assert crawl.expand(none, roots).count() == roots.count() and crawl.expand(none, roots.where("false")).count() == 0


def test_redirects_end_or_run_in_circles(spark):
    edges = [(f"u{i}", f"u{i + 1}") for i in range(100)] + [("u3", "zzz"), ("self", "self"), ("x", "y"), ("y", "z"), ("z", "x"), ("to circle", "x"), ("one", "self"), (None, "u1"), ("u200", None)]
    edges += [(f"hot{i}", "u99") for i in range(50)] + [("u5", "u6")] * 3
    got = {r.url: (r.final, r.hops) for r in crawl.final_urls(spark.createDataFrame(edges, "url string, target string")).collect()}
    want = {f"u{i}": ("u100", 100 - i) for i in range(100)} | {u: (None, None) for u in ("x", "y", "z", "to circle")} | {"one": ("self", 1)} | {f"hot{i}": ("u100", 2) for i in range(50)}
    assert got == want
    assert crawl.final_urls(spark.createDataFrame([], "url string, target string")).count() == 0


def test_search_finds_what_contains_does(spark):
    draw = random.Random(4)
    words = ["Alpha", "beta", "betamax", "gam-ma", "Ünï", "x1", "the", "نفط", "***"]
    rows = [(i, f"g{i % 7}", " ".join(draw.choice(words) + draw.choice(["", ",", "."]) for _ in range(draw.randint(0, 8)))) for i in range(120)] + [(200, "g1", None), (3, "g9", "beta the repeated id")]
    members = spark.createDataFrame(rows, "id bigint, component string, text string")
    asked = ["beta", "beta, the", "a b", "MMA X", "ünï", "نفط", "***", ".", "the the", "", "nothing", "ph", "eta. g", "the"]
    found = search.search(search.build(members), members, asked)
    want = {(q.strip().lower(), i, g) for q in asked if q for i, g, t in rows if q.strip().lower() in (t or "").lower()}
    assert {(r.query, r.id, r.component) for r in found.collect()} == want
    assert {(r.query, r.group): r.members for r in search.groups(found).where("query = 'beta'").collect()}[("beta", "g9")] == 1
    assert search.search(search.build(members), members, [""]).columns == ["query", *members.columns]


def test_extended_components_equal_a_full_run(spark):
    draw = random.Random(8)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").withColumn("day", F.monotonically_increasing_id() % 3)
    labels = components.connected_components(df.where("day = 0"))
    for day in (1, 2):
        labels = components.extended(labels, df.where(F.col("day") == day))
    full = {r.id: r.component for r in components.connected_components(df).collect()}
    assert {r.id: r.component for r in labels.collect()} == full
    assert components.extended(labels, df.where("false")).count() == len(full)
