import random
import re
from pathlib import Path

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from tidewire.functions import ids, lexicon, text, urls
from tidewire.operators import discovery, enrich, events, incremental, profiles, ranking, rules, similarity, views
from tidewire.operators.components import connected_components
from tidewire.plans import SQL
from tidewire.sources import html

SF = "/root/testdata/sf0.001"


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def test_normalising_arabic(spark):
    assert one(spark, text.normalize(F.col("t")), t="إِعْلَان  الدولـــة على") == "اعلان الدوله علي"
    assert one(spark, text.normalize(F.col("t"), "event"), t="نفط abc 30مليون") == "نفط 30مليون"
    assert one(spark, text.normalize(F.col("t"), "origin"), t="ﬁﬂ ①") == "fi fl 1".replace(" ", "", 1)
    assert one(spark, text.numbers(F.col("t")), t="و30مليون a5 7.5 7.5") == ["30", "7.5"]
    assert one(spark, text.canonical_token(F.col("t")), t="بالعراق") == "عراق"
    assert one(spark, text.clamp(F.lit(2.5))) == 3


def test_scope_gate_fixture(spark):
    rows = [
        ("abroad", "security", "مسلحون يقتحمون سوقا في نيجيريا", "قال سكان في سوكوتو إن المهاجمين فروا ليلا.", "FOREIGN_SECURITY_PRIMARY_TITLE"),
        ("wasit", "security", "ضبط مخزن أسلحة في واسط", "ذكر بيان أن المخزن يعود إلى مطلوبين.", None),
        ("prefixed", "security", "تفكيك خلية نائمة بالعراق", "لم تعلن تفاصيل أخرى.", None),
        ("syria", "security", "تفجير في سوريا قرب محطة وقود", "تتابع دول عدة منها العراق ما يجري.", "FOREIGN_SECURITY_PRIMARY_TITLE"),
        ("border", "security", "نصب كاميرات جديدة على الحدود العراقية السورية", "تغطي الكاميرات نقاطا نائية.", None),
        ("economy", "economy", "خبر عن السوق", "كلام", None),
    ]
    got = spark.createDataFrame(rows, "id string, category string, title string, body string, want string")
    for r in got.select("id", "want", profiles.scope(F.col("category"), F.col("title"), F.col("body")).alias("reason")).collect():
        assert r.reason == r.want, r.id


def test_scope_query_reads_the_lead_of_the_reference(spark, tmp_path):
    fill = lambda n: ("x" * 9 + " ") * (n // 10)
    rows = [
        (1, f"title. {fill(150)} the end", None), (2, f"title. {fill(400)} the end", None), (3, f"title. {fill(1600)} the end", None), (4, f"title. {fill(2150)} the end", None),
        (5, f"title. {fill(2300)} the end", "NO_HOME_EVIDENCE"), (6, f"title. {fill(400)}", "NO_HOME_EVIDENCE"), (7, f"title of it. {fill(400)} the end", "FOREIGN_SECURITY_PRIMARY_TITLE"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t, _ in rows], "doc_id bigint, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.id: r.reason for r in __spark_entry__.queries()["scope_gate"](spark, str(tmp_path)).collect()} == {i: want for i, _, want in rows}


def test_audit_fixture(spark):
    rows = [
        ("REVIEWED", "إغلاق جسر غزة أسبوعا للصيانة", "قالت أمانة العاصمة إن الصيانة في بغداد تشمل الأرصفة."),
        ("SUSPECT", "إعادة فتح طريق في قطاع غزة", "استؤنفت الحركة بعد الظهر."),
        ("SUSPECT", "مصر تبدأ توزيع شقق في القاهرة", "يستمر التوزيع حتى نهاية الشهر."),
        ("REVIEWED", "مصر والعراق يوقعان مذكرة نقل", "جرى التوقيع في بغداد."),
    ]
    got = spark.createDataFrame(rows, "want string, title string, body string").select("want", profiles.audit(F.col("title"), F.col("body")).alias("x")).collect()
    assert all(r.want == r.x for r in got)


def test_importance_floors(spark):
    stalled = "مجلس النواب يطلب توصيات حول المشاريع المتوقفة في جميع المحافظات"
    floor = one(spark, profiles.category_floor(F.lit("경제/건설"), F.col("t")), t=stalled)
    assert (floor.score, floor.rule) == (78, "ECONOMY_NATIONAL_STALLED_PROJECT_OVERSIGHT")
    assert one(spark, profiles.category_floor(F.lit("construction"), F.col("t")), t="بطء في تعبيد شارع فرعي").score == 0
    direct = "زار وفد من هانوا والهيئة الوطنية للاستثمار موقع بسماية"
    assert tuple(one(spark, profiles.business_floor(F.col("t"), F.col("t")), t=direct)) == (98, "BISMAYAH_NIC_HANWHA_DIRECT")
    assert one(spark, profiles.canonical_category(F.lit("경제/건설"))) == "economy" and one(spark, profiles.canonical_category(F.lit("other"))) == "other"


def test_url_policy_fixture(spark):
    host, sources, methods = profiles.AGGREGATOR
    cases = [
        ("https://hathalyoum.net/articles/123", True, "hathalyoum", "priority-source-index", False),
        ("https://hathalyoum.net/articles/123", False, "hathalyoum", "priority-source-index", True),
        ("https://hathalyoum.net/articles/123", True, "ina", "priority-source-index", True),
        ("https://hathalyoum.net/articles/123", True, "hathalyoum", "source-listing", True),
        ("https://hathalyoum.net/category/iraq", True, "hathalyoum", "priority-source-index", True),
        ("https://ina.iq/articles/1001", False, "ina", "x", False),
        ("https://news.google.com/rss/articles/example", False, "x", "x", True),
        ("", False, "x", "x", True),
    ]
    rows = spark.createDataFrame(cases, "u string, flag boolean, source string, method string, want boolean")
    exempt = urls.aggregator_exempt(F.col("u"), F.col("flag"), F.col("source"), F.col("method"), host, sources, methods)
    assert all(r.want == r.x for r in rows.select("want", urls.forbidden(F.col("u"), [host, "google.com"], exempt).alias("x")).collect())


def test_urls(spark):
    assert one(spark, urls.canonical(F.col("u")), u="HTTPS://Www.Example.COM:443/a?utm_source=x&b=1&fbclid=2#top") == "https://www.example.com/a?b=1"
    assert one(spark, urls.canonical(F.col("u")), u="no url") == ""
    assert one(spark, urls.best_candidate(F.array(F.lit("https://a.b/about"), F.lit("https://a.b/news/12345"), F.lit("https://a.b/news/54321")))) == "https://a.b/news/12345"
    token = "CBMiGmh0dHBzOi8vcHVibGlzaGVyLmV4YW1wbGUvYQ"
    assert one(spark, html.embedded_url(F.col("t")), t=token) == "https://publisher.example/a"


def test_html(spark):
    page = '<meta content="d" name="description"><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"H","articleBody":"B"}]}</script><script type="application/ld+json">{bad</script><article>one<script>x</script> two</article>'
    assert one(spark, html.meta(F.col("p"), "description"), p=page) == "d" and one(spark, html.best_text(F.col("p")), p=page) == "one two"
    assert [n.headline for n in one(spark, html.json_ld(F.col("p")), p=page)] == [None, "H"]
    assert one(spark, html.strip_blocks(F.col("p")), p="<p>a</p><p>b<br>c</p>") == "a\nb\nc"
    assert one(spark, html.decode_entities(F.col("p"), numeric=True), p="&#65;&amp;&#x42;") == "A&B"


def test_json_ld_nodes_at_any_depth(spark):
    script = lambda body: f'<script async type="application/ld+json">{body}</script>'
    pages = spark.createDataFrame([
        (1, script('{"@graph":[{"@type":["NewsArticle","Article"],"headline":"H","author":[{"name":"N"}]},[{"x":{"y":{"url":"u","name":5}}}]]}') + script("{broken") + script('"text"')),
        (2, "<p></p>"), (3, None), (4, script("[]") + script("{}") + script('{"@type":"A","articleBody":"b"}')),
    ], "page_id bigint, html string")
    got = sorted(tuple(r) for r in html.json_ld_nodes(pages).select("page_id", "script", "path", "type", "headline", "name", "article_body", "url").collect())
    assert got == sorted([
        (1, 0, "$", None, None, None, None, None), (1, 0, "$.@graph[0]", "NewsArticle Article", "H", None, None, None), (1, 0, "$.@graph[0].author[0]", None, None, "N", None, None),
        (1, 0, "$.@graph[1][0]", None, None, None, None, None), (1, 0, "$.@graph[1][0].x", None, None, None, None, None), (1, 0, "$.@graph[1][0].x.y", None, None, None, None, "u"),
        (4, 1, "$", None, None, None, None, None), (4, 2, "$", "A", None, None, "b", None),
    ])


def test_page_metadata_and_publishers_links(spark):
    pages = spark.createDataFrame([
        ("https://a.example/1", '<h1>Heading</h1><meta property="og:title" content="Other"><meta property="article:published_time" content="2026-08-01T10:00:00Z"><link rel="canonical" href="https://a.example/c?fbclid=1">'),
        ("https://a.example/2", '<meta name="twitter:title" content="By metadata"><time datetime="2026-08-02T00:00:00Z"></time><meta property="og:url" content="https://a.example/o">'),
        ("https://a.example/3", "<p></p>"),
    ], "url string, html string")
    info = discovery.page_info(F.col("html"), F.col("url"))
    got = [(r.title, r.date and str(r.date), r.canonical) for r in pages.select("url", *(info[c].alias(c) for c in ("title", "date", "canonical"))).orderBy("url").collect()]
    assert got == [("Heading", "2026-08-01 10:00:00", "https://a.example/c"), ("By metadata", "2026-08-02 00:00:00", "https://a.example/o"), (None, None, "https://a.example/3")]
    aggregated = spark.createDataFrame([
        ("https://agg.example/1", '<a href="https://b.example/news/1">شاهد</a><a href="https://c.example/news/2">المصدر</a><a href="https://facebook.com/a/1234">المصدر</a><a href="/own/page/1">المصدر</a>'),
        ("https://agg.example/2", '<a href="https://b.example/">x</a><a href="https://b.example/news/1?gclid=2">x</a><a href="https://c.example/news/2">x</a>'), ("https://agg.example/3", "<p></p>"),
    ], "url string, html string")
    assert {tuple(r) for r in discovery.publisher_link(aggregated).collect()} == {("https://agg.example/1", "https://c.example/news/2"), ("https://agg.example/2", "https://b.example/news/1")}


def test_queue_candidates_and_answers(spark):
    rows = spark.createDataFrame([(1, True, False, 50, 1), (2, True, False, 90, 1), (3, False, False, 99, 1), (4, True, True, 99, 1), (5, True, None, 50, 2), (6, True, False, None, 9)], "id bigint, usable boolean, current boolean, score int, ts int")
    queue = enrich.work_queue(rows, F.col("usable"), F.col("current"), F.col("score"), F.col("ts"), 10)
    assert [r.id for r in queue.collect()] == [2, 5, 1, 6]
    rows = spark.createDataFrame([(1, True, 0, 10, False), (2, False, 98, 70, False), (3, False, 0, 59, False), (4, False, 0, 60, None), (5, True, 90, 80, True)], "id bigint, direct boolean, floor int, rule int, cached boolean")
    asked = enrich.candidates(rows, F.col("direct"), F.col("floor"), F.col("rule"), F.col("cached"))
    answers = spark.createDataFrame([(1, 7.0), (4, 9.0), (5, 1.0), (99, 1.0)], "id bigint, score double")
    got = {(r.id, r.priority, r.score) for r in enrich.enriched(asked, asked, lambda queue: answers, "score").collect()}
    assert got == {(1, 1001000, 7.0), (2, 987000, None), (4, 6000, 9.0)}


def test_answers_by_retries_and_fallbacks(spark):
    queue = spark.range(6)
    asked = []

    def odd(rows, attempt):
        asked.append((attempt, sorted(r.id for r in rows.collect())))
        return spark.createDataFrame([(1, "a"), (1, "b"), (99, "x"), (2, None), *([(3, "late")] if attempt == 2 else [])], "id bigint, v string")

    rest = lambda rows, attempt: rows.where("id <> 4").selectExpr("id", "'r' AS v")
    got = {tuple(r) for r in enrich.answered(queue, {"odd": odd, "rest": rest}, "v").collect()}
    assert got == {(1, "b", "odd", 1), (3, "late", "odd", 2), (0, "r", "rest", 1), (2, "r", "rest", 1), (5, "r", "rest", 1)}
    assert asked == [(1, [0, 1, 2, 3, 4, 5]), (2, [0, 2, 3, 4, 5])]
    assert enrich.answered(queue.where("false"), {"rest": rest}, "v").count() == 0


def test_glossary_and_signature(spark):
    entries = {"council": ["مجلس الوزراء"], "capital": ["بغداد"], "city": ["مدينة بسماية الجديدة"]}
    assert one(spark, lexicon.glossary_terms(F.col("t"), entries), t="بغداد: مجلس الوزراء يزور مدينة بسماية الجديدة") == ["city", "council", "capital"]
    assert len(one(spark, ids.fingerprint(F.lit("x")))) == 20 and one(spark, ids.content_hash(F.lit(""), F.lit(None).cast("string"))) == ""


def test_report_references(spark):
    clusters = spark.createDataFrame([("07", "politicsItems", ["politicsItems", "economyItems"]), ("08", "politicsItems", ["politicsItems", "economyItems"]), ("17", "internationalItems", ["internationalItems"])], "cluster_id string, target_section string, allowed_sections array<string>")
    refs = [("politicsItems", 0, "07"), ("politicsItems", 0, "08"), ("economyItems", 0, "07"), ("economyItems", 1, "08"), ("internationalItems", 0, "07"), ("internationalItems", 0, "08"), ("internationalItems", 0, "17"), ("economyItems", 2, "99")]
    kept, dropped = ranking.cluster_keepers(spark.createDataFrame(refs, "section string, item_index int, cluster_id string"), clusters)
    assert {tuple(r) for r in kept.collect()} == {("economyItems", 0, "07"), ("economyItems", 1, "08"), ("internationalItems", 0, "17")}
    assert {r.reason for r in dropped.collect()} == {"unknown-cluster", "section-not-allowed:internationalItems", "duplicate-reference"}


def test_retention_policies(spark):
    rows = spark.createDataFrame([("a", "2024-01-14 14:59:00"), ("b", "2024-01-13 15:00:00"), ("c", "2024-01-13 14:59:59"), ("d", None)], "id string, t string").withColumn("ts", F.try_to_timestamp("t"))
    end = F.lit("2024-01-14").cast("date")
    assert {r.id for r in rows.where(incremental.in_rolling_days(F.col("ts"), end, 1)).collect()} == {"a", "b"}
    rows = spark.createDataFrame([("old", "2024-01-01"), ("new", "2024-01-09"), ("missing", ""), ("bad", "??")], "id string, t string").withColumn("ts", F.try_to_timestamp("t"))
    assert {r.id for r in rows.where(incremental.in_rolling_hours(F.col("t"), F.col("ts"), F.lit("2024-01-10").cast("timestamp"), 7)).collect()} == {"new", "bad"}


def test_snapshot_is_idempotent(spark):
    seeds = spark.createDataFrame([("u1",), ("u2",)], "url string")
    articles = spark.createDataFrame([("u1", ""), ("x", None)], "canonical string, original string")
    new = incremental.insert_missing(seeds, articles, "url", ["canonical", "original"])
    assert [r.url for r in new.collect()] == ["u2"]
    again = articles.unionByName(new.select(F.col("url").alias("canonical"), F.lit("").alias("original")))
    assert incremental.insert_missing(seeds, again, "url", ["canonical", "original"]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, pairs):
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: top(i) for i in up}


def test_similar_pairs_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, draw.sample("abcdefghijklm", draw.randint(1, 8))) for i in range(80)]
    reps, members = similarity.set_classes(spark.createDataFrame(rows, "id bigint, s array<string>"), "id", "s")
    least = {}
    for i, s in rows:
        least.setdefault(frozenset(s), i)
    want = {(min(a, b), max(a, b)) for x, a in least.items() for y, b in least.items() if a < b and len(x & y) / len(x | y) >= 0.6}
    assert {(r.a, r.b) for r in similarity.similar_pairs(reps, 0.6).collect()} == want
    assert {r.id: r.rep for r in members.collect()} == {i: least[frozenset(s)] for i, s in rows}


def test_similar_pairs_at_the_threshold_and_of_repeated_ids(spark):
    # 0.55 * 20 is a little over 11 in floating point; the 11 common elements are the most frequent ones.
    wide, narrow = [f"x{i}" for i in range(9)] + [f"y{i}" for i in range(11)], [f"y{i}" for i in range(11)]
    far = [(100 + i, [f"y{i}", f"z{i}", f"z{i + 1}", f"z{i + 2}", f"x{i % 9}"]) for i in range(11)]
    rows = [(1, wide), (2, narrow), (2, [f"w{i}" for i in range(8)]), (3, [f"w{i}" for i in range(7)]), (4, narrow[::-1]), (5, []), (None, wide), *far]
    got = similarity.similar_pairs(spark.createDataFrame(rows, "id bigint, set array<string>"), 0.55).collect()
    assert sorted((r.a, r.b, r.similarity) for r in got) == [(1, 2, 0.55), (2, 3, 0.875)]


def test_similar_pairs_of_long_and_short_sets_on_little_disk(spark, monkeypatch):
    draw = random.Random(8)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(40_000)]
    bases = [draw.sample(vocabulary, draw.choice([4, 30, 200, 900])) for _ in range(60)]
    vary = lambda s: [w for w in s if draw.random() < 0.9] + draw.sample(vocabulary, len(s) // 8)
    rows = [(i, sorted(set(s))) for i, s in enumerate([*bases, *(vary(s) for s in bases * 3), *(vary(s + draw.choice(bases)) for s in bases)])]
    least = {}
    for i, s in rows:
        if s:
            least.setdefault(frozenset(s), i)
    for room in (similarity.NUMBERED, 50, 0):
        monkeypatch.setattr(similarity, "NUMBERED", room)
        for t in (0.3, 0.5, 0.8):
            want = {(a, b): len(x & y) / len(x | y) for x, a in least.items() for y, b in least.items() if a < b and len(x & y) >= t * len(x | y)}
            assert {(r.a, r.b): r.similarity for r in similarity.similar_pairs(spark.createDataFrame(rows, "id bigint, set array<string>"), t).collect()} == want and len(want) > 20
    shared = Path(spark.conf.get("spark.checkpoint.dir"), "tidewire")
    before = {p: p.stat().st_size for p in shared.rglob("*.parquet")}
    similarity.similar_pairs(spark.createDataFrame(rows, "id bigint, set array<string>"), 0.5).collect()
    left = sum(p.stat().st_size for p in shared.rglob("*.parquet") if p not in before)
    assert left < 5 * sum(len(s) for _, s in rows)


def test_set_queries_read_whole_texts(spark, tmp_path):
    words = lambda stem, n: " ".join(f"{stem}{''.join(chr(97 + int(c)) for c in str(i))}" for i in range(n))
    long, other, third = words("long", 90), words("other", 90), words("third", 90)
    texts = {1: f"{words('opening', 60)} {long}", 2: f"{words('opening', 60)} {other}", 3: f"{words('elsewhere', 40)} {third} {long}", 4: f"{words('another', 40)} {third} {long}", 5: f"{words('opening', 60)} {long}"}
    docs = [(i, t, "en", "s") for i, t in texts.items()]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    entries = {7: f"{words('opening', 60)} {words('unlike', 90)}", 8: f"{words('prelude', 60)} {texts[3]}"}
    spark.createDataFrame(list(entries.items()), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    of, plans = {i: frozenset(t.split()) for i, t in texts.items()}, __spark_entry__.queries()
    least = {i: min(j for j, t in of.items() if t == s) for i, s in of.items()}
    assert {r.id: r.rep for r in plans["set_classes"](spark, str(tmp_path)).collect()} == least
    alike = {(a, b): len(x & y) / len(x | y) for a, x in of.items() for b, y in of.items() if a < b and {a, b} <= set(least.values())}
    got = {(r.a, r.b): r.similarity for r in plans["set_similarity_pairs"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({p: s for p, s in alike.items() if s >= 0.5}) and set(got) == {(3, 4)}
    best = {}
    for i, x in of.items():
        for e, y in ((e, frozenset(t.split())) for e, t in entries.items()):
            score = int((0.7 * len(x & y) / min(len(x), len(y)) + 0.3 * len(x & y) / len(x | y)) * 10_000 + 0.5) / 10_000
            if score >= 0.3:
                best[i] = max(best.get(i, (0, 0)), (score, -e))
    found = {r.item_id: (r.similarity, -r.entry_id) for r in plans["title_recovery_best"](spark, str(tmp_path)).collect()}
    assert found == best and found[3][1] == -8


def test_event_queries_use_numbers(spark, tmp_path):
    filler = lambda i, n: " ".join(f"{'abcdef'[i]}{chr(97 + j // 26)}{chr(97 + j % 26)}x" for j in range(n))
    texts = [
        f"alpha beta gamma delta. {filler(0, 60)} 4711 {filler(0, 60)}",
        f"alpha beta gamma epsilon. {filler(1, 270)} 4711 {filler(1, 60)}",
        f"alpha beta gamma zeta. {filler(2, 120)} 4712",
        f"alpha beta gamma theta. {filler(3, 120)}",
        f"one two three seven. {filler(4, 300)} 99",
        f"one two three eight. {filler(5, 20)} 99",
    ]
    assert 1400 - len("alpha beta gamma epsilon\n") < texts[1].index("4711") < 1396 and texts[4].index("99") > 1400
    docs = [(i, t, "en", "s") for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    share = lambda x, y: len(x & y) / len(x | y) if x and y else 0
    of = []
    for t in texts:
        title = t[: t.index(".")]
        lead = {w for w in re.findall("[a-z0-9]+", f"{title}\n{t}"[:1400]) if len(w) >= 3}
        of.append((set(title.split()), lead, set(re.findall("[0-9]+", t[:1400]))))
    want = {}
    for a, (x, l, n) in enumerate(of):
        for b, (y, m, k) in list(enumerate(of))[a + 1 :]:
            score = 0.29 * share(x, y) + 0.29 * len(x & y) / min(len(x), len(y)) + 0.18 * share(l, m) + 0.12 * share(n, k)
            if len(x & y) >= 3 and score >= 0.5:
                want[a, b] = round(score, 6)
    plans = __spark_entry__.queries()
    got = {(r.a, r.b): r.score for r in plans["event_pairs"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx(want) and set(got) == {(0, 1)}
    assert {r.id: r.component for r in plans["event_groups"](spark, str(tmp_path)).collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
    assert {r.component: r.member_count for r in plans["event_group_stats"](spark, str(tmp_path)).collect()} == {0: 2, 2: 1, 3: 1, 4: 1, 5: 1}


def test_undated_reports_match_each_other_only(spark):
    title = "Ministry signs contract for the new river bridge"
    rows = [(1, "c", title, "x", None), (2, "c", title, "y", None), (3, "c", title, "z", "2024-01-01 10:00:00"), (4, "c", title, "w", "2024-01-02 10:00:00")]
    feats = events.features(spark.createDataFrame(rows, "id bigint, category string, title string, body string, at string").withColumn("published_at", F.to_timestamp("at")))
    assert {(r.a, r.b) for r in events.match_edges(feats).collect()} == {(1, 2), (3, 4)}
    parts = {r.id: r.component for r in similarity.grouped(feats.select("id"), events.group_edges(feats)).collect()}
    assert parts == {1: 1, 2: 1, 3: 3, 4: 3}


def test_group_edges_join_what_match_edges_join(spark):
    draw = random.Random(5)
    titles = [" ".join(draw.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]) for _ in range(draw.randint(1, 5))) for _ in range(12)]
    rows = [(i, draw.choice("xy"), f"2024-01-{draw.randint(1, 28):02d} 10:00:00", draw.choice(titles), draw.choice(["one two three", "four five six 12"])) for i in range(150)]
    articles = spark.createDataFrame(rows, "id bigint, category string, t string, title string, body string").withColumn("published_at", F.to_timestamp("t"))
    feats = events.features(articles)
    of = lambda edges: {r.id: r.component for r in similarity.grouped(articles.select("id"), edges).collect()}
    assert of(events.match_edges(feats)) == of(events.group_edges(feats))


def _one_title(spark, n, title="Ministry signs contract for the new river bridge"):
    """Features of n reports of one title, each with a lead of its own."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(7))
    rows = [(i, "c", title, " ".join(word() for _ in range(150)), f"2024-01-02 10:{i % 60:02d}:00") for i in range(n)]
    return events.features(spark.createDataFrame(rows, "id bigint, category string, title string, body string, at string").withColumn("published_at", F.to_timestamp("at")))


def test_pairs_of_one_title_carry_no_leads_through_shuffles(spark):
    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    took = []
    for n in (100, 200):
        feats, before = _one_title(spark, n).cache(), shuffled()
        assert events.match_edges(feats).count() == n * (n - 1) // 2
        took.append(shuffled() - before)
        feats.unpersist()
    assert took[1] < 2.5 * took[0]


@pytest.mark.parametrize("block", [3, 4096])
def test_match_edges_are_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(events, "BLOCK", block)
    draw = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "in", "of", "antidisestablishment"]
    titles = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 6))) for _ in range(25)]
    rows = [(i, draw.choice(["x", "y", "y", None]), draw.choice([None, f"2024-01-{draw.randint(1, 9):02d} 10:00:00"]), draw.choice([*titles, None]), draw.choice(["one two three", "four five six 12", "12 one", None]), draw.choice(["", "fire", None])) for i in range(160)]
    articles = spark.createDataFrame(rows, "id bigint, category string, t string, title string, body string, incident string").withColumn("published_at", F.to_timestamp("t"))
    language = events.Language(aliases={"G": ["gamma"], "T": ["two"]}, actions={"up": ["alpha"], "down": ["beta"]})
    feats = events.features(articles, language).cache()
    side = lambda p: feats.select(*(F.col(c).alias(f"{p}_{c}") for c in feats.columns))
    near = (F.col("a_category") == F.col("b_category")) & (F.col("a_id") < F.col("b_id")) & (events._hours_apart() <= events.HOURS) & (events.common(F.col("a_title_tokens"), F.col("b_title_tokens")) > 0)
    want = {(r.a_id, r.b_id): r.score for r in side("a").join(side("b"), near).withColumn("score", events.pair_score(incident=True)).where("score >= 0.5").select("a_id", "b_id", "score").collect()}
    got = [((r.a, r.b), r.score) for r in events.match_edges(feats).collect()]
    assert len(want) > 100 and len(got) == len(want) and dict(got) == pytest.approx(want)
    of = lambda edges: {r.id: r.component for r in similarity.grouped(articles.select("id"), edges).collect()}
    assert of(events.match_edges(feats)) == of(events.group_edges(feats))


def test_reports_of_one_title_are_linked_without_all_pairs(spark):
    edges = events.group_edges(_one_title(spark, 60))
    assert {(r.a, r.b) for r in edges.collect()} == {(i, 0) for i in range(60)}


def test_views(spark):
    rows = spark.createDataFrame([(1, "a", 95, 1), (2, "a", None, 1), (3, "b", 65, 3)], "id bigint, category string, score int, component bigint")
    assert {r.id: views_bucket for r, views_bucket in ((r, r.x) for r in rows.select("id", views.score_bucket(F.col("score")).alias("x")).collect())} == {1: "90+", 2: "pending", 3: "60-69"}
    assert {r.rule for r in views.violations(rows, "id", {"NO_SCORE": ("warning", F.col("score").isNull())}).collect()} == {"NO_SCORE"}
    assert one(spark, rules.level(F.lit(80))) == "VERY_HIGH" and one(spark, rules.blend(F.lit(50), F.lit(None).cast("int"), F.lit(60))) == 60


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents pages benchmark labels conversations").split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = __spark_entry__.queries()[name](spark, SF)
    got, want = df.collect(), con.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    cell = lambda v: "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(cell(r[n]) for n in names) for r in got) == sorted(tuple(map(cell, r)) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
