import tracemalloc
from itertools import combinations

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.functions import automaton, lexicon, text
from tidewire.operators import arabic_rules, discovery, events, similarity
from tidewire.plans import PLANS, SQL

SCHEMA = "id string, category string, title string, body string"



def test_rules_give_what_the_registered_queries_say(spark, tmp_path):
    """Gate, router, overrides, validation, importance, promotion and floors, a case for every document."""
    spark.range(40).selectExpr("CASE WHEN id < 38 THEN id END AS doc_id", "CASE WHEN id % 9 > 0 THEN 'text' END AS text").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("arabic_strict_gate", "arabic_gate_by_keyword", "arabic_direct_route", "arabic_category_override", "arabic_validation", "arabic_importance", "arabic_promotion", "arabic_floors"):
        got = PLANS[name](spark, str(tmp_path))
        want = con.execute(SQL[name])
        assert got.columns == [c[0] for c in want.description], name
        rows = sorted(map(str, (tuple(r) for r in got.collect())))
        assert rows == sorted(map(str, want.fetchall())) and len(rows) == 38, name


def test_validation_by_keyword_and_section(spark):
    rows = [
        ("required", "economy", "مشروع في بغداد", "", "", ["شركة هانوا"], None, "KEYWORD_CONTEXT_MISMATCH"),
        ("excluded", "economy", "مشروع في بغداد", "مهرجان", "", None, ["مهرجان"], "LOW_RELEVANCE_ECONOMY"),
        ("section", "security", "انفجار كبير", "", "https://www.shafaq.com/ar/%D8%A7%D9%84%D9%85%D9%86%D8%B7%D9%82%D8%A9-%D9%88%D8%A7%D9%84%D8%B9%D8%A7%D9%84%D9%85/x", None, None, "FOREIGN_SECURITY_EVENT"),
        ("broken url", "security", "انفجار كبير", "", "http://[x", None, None, "NON_IRAQ_RELATED"),
    ]
    df = spark.createDataFrame([r[:7] for r in rows], SCHEMA + ", url string, required_terms array<string>, excluded_terms array<string>")
    assert {r.id: r.error_code for r in arabic_rules.validated(df).collect()} == {r[0]: r[7] for r in rows}


LEAD = "التقى التمثيل التجاري المصري ممثلين عن الهيئة الوطنية للاستثمار وناقش التعاون الاستثماري بين مصر والعراق"
REPORTS = [
    (1, "10:00", "لقاء مصري عراقي جديد", LEAD), (2, "12:00", "مصر والعراق وحركة المستثمرين", LEAD), (3, "20:00", "التمثيل التجاري في بغداد", LEAD), (4, "23:00", "خبر قصير", "نفط"),
    (5, "10:00", "تكليف عادل الياسري", "الهيئة الوطنية للاستثمار"), (6, "22:00", "تعيين رئيس جديد", "عادل داخل الياسري رئيس هيئة الاستثمار الوطنية"), (7, "11:00", "إعفاء عادل الياسري", "الهيئة الوطنية للاستثمار"),
    (8, "10:05", "إقالة ثم تعيين", LEAD), (9, "10:07", "إقالة", LEAD),
]


def test_sure_matches(spark):
    articles = spark.createDataFrame(REPORTS, "id bigint, t string, title string, body string").select("id", F.lit("x").alias("category"), F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("published_at"), "title", "body")
    feats = events.features(articles, arabic_rules.EVENT_LANGUAGE)
    found = {(r.a, r.b): round(r.score, 2) for r in events.match_edges(feats, sure=arabic_rules.EVENT_SURE).collect()}
    assert found[1, 2] == 0.93 and found[1, 3] == 0.93 and found[5, 6] == 0.96
    assert not any(4 in pair for pair in found) and (5, 7) not in found and (6, 7) not in found
    of = lambda edges: {r.id: r.component for r in similarity.grouped(articles.select("id"), edges).collect()}
    assert of(events.match_edges(feats, sure=arabic_rules.EVENT_SURE)) == of(events.group_edges(feats, sure=arabic_rules.EVENT_SURE))


@pytest.mark.parametrize("seed", range(2))
def test_sure_links_join_what_sure_pairs_join(spark, seed):
    import random

    draw, names = random.Random(seed), ["p", "q"]
    rows = [(i, draw.choice(names), draw.choice(["c", "d"]), [a for a in ("x", "y") if draw.random() < 0.3], draw.randint(0, 400)) for i in range(60)]
    rule = events.Sure(0.9, 3, (("p", "q"), ("c",)))
    empty = F.array().cast("array<string>")
    df = spark.createDataFrame(rows, "id bigint, s1 string, cue string, actions array<string>, h bigint")
    feats = df.select("id", F.lit("k").alias("category"), F.timestamp_seconds(F.col("h") * 3600).alias("published_at"), F.concat(F.lit("t"), F.col("id")).alias("title"),
                      empty.alias("title_tokens"), empty.alias("lead_tokens"), F.array("s1").alias("signals"), "actions", F.array("cue").alias("cues"), empty.alias("numbers"))
    want = {(a[0], b[0]) for a, b in combinations(rows, 2) if a[1] == b[1] and a[2] == b[2] == "c" and abs(a[4] - b[4]) <= 3 and not (a[3] and b[3] and not set(a[3]) & set(b[3]))}
    pairs = events.match_edges(feats, sure=(rule,))
    assert {(r.a, r.b) for r in pairs.collect()} == want
    of = lambda edges: {r.id: r.component for r in similarity.grouped(df.select("id"), edges).collect()}
    assert of(pairs) == of(events.group_edges(feats, sure=(rule,)))


def test_plans_of_sure_matches_do_not_grow_with_rules(spark):
    """Rules of several families and lengths in one step; the last plan joins what earlier ones wrote."""
    rows = [(1, "a", ["p", "c"], 0), (2, "a", ["p", "d"], 1), (3, "a", ["c", "d"], 3), (4, "b", ["p", "c"], 0), (5, "a", ["p", "c", "d"], 5), (6, None, ["p", "c"], 0), (7, "", ["p", "c"], 0)]
    empty = F.array().cast("array<string>")
    timed = spark.createDataFrame(rows, "id bigint, category string, signals array<string>, h bigint").withColumns({"s": F.col("h") * 3600.0, "actions": empty, "cues": empty})
    rules = (events.Sure(0.9, 1, (("p",), ("c", "d"))), events.Sure(0.8, 2, (("d",),)), events.Sure(0.7, 5, (("c",), ("p", "d"))))
    of = lambda some: events._sure_pairs(timed, some)
    meet = lambda rule, x, y: x[1:2] == y[1:2] and abs(x[3] - y[3]) <= rule.hours and all(set(f) & set(x[2]) & set(y[2]) for f in rule.families)
    told = [(i, c or "", s, h) for i, c, s, h in rows]
    for some in (rules, rules[:1], rules[1:]):
        assert {(r.a_id, r.b_id) for r in of(some).collect()} == {(x[0], y[0]) for x, y in combinations(told, 2) if any(meet(rule, x, y) for rule in some)}
    sizes = [of(some)._jdf.queryExecution().optimizedPlan().toString().count("\n") for some in (rules[:1], rules)]
    assert sizes[0] == sizes[1]
    articles = spark.createDataFrame(REPORTS, "id bigint, t string, title string, body string").select("id", F.lit("x").alias("category"), F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("published_at"), "title", "body")
    plan = events.match_edges(events.features(articles, arabic_rules.EVENT_LANGUAGE), sure=arabic_rules.EVENT_SURE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 3 and "Generate" not in plan and "Window" not in plan


def test_alias_signals_are_one_step_of_a_plan(spark):
    """Names stand in their order, between blanks, overlapping ones too; the plan doesn't grow with the aliases."""
    names = {"B": ["new york", "nyc"], "A": ["york"], "NONE": ["bridge"]}
    texts = ["new york bridges", "york", "newyork nyc", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(1)
    assert [r.s for r in rows.select("id", lexicon.alias_signals(F.col("t"), names).alias("s")).orderBy("id").collect()] == [["B", "A"], ["A"], ["B"], [], []]
    told = [len(lexicon.alias_signals(F.col("t"), aliases)._jc.toString()) for aliases in (names, arabic_rules.EVENT_LANGUAGE.aliases)]
    assert abs(told[0] - told[1]) < 50


def test_scans_hold_few_texts_as_strings():
    texts = pa.array([("x" * 20_000) + str(i) for i in range(2_000)])
    tracemalloc.start()
    found = automaton._listed(texts, ("x1999", "y"), pa.list_(pa.int32()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 2_000 and found[1_999].as_py() == [0] and sum(len(f) for f in found.to_pylist()) == 1
    assert peak < 5_000_000


def test_recovery_deals_the_items_of_one_source_to_many_tasks(spark):
    items = spark.createDataFrame([(f"i{i}", "https://a.example", "", title) for i, title in enumerate(["oil ministry plan", "oil ministry plan", "new oil plan", "other words"])] + [("i0", "https://a.example", "", "oil ministry plan")], "item_id string, homepage string, source string, title string")
    sources = spark.createDataFrame([("a", ["a.example"], ["agency"])], "source_id string, hosts array<string>, names array<string>")
    index = spark.createDataFrame([("a", 1, "u1", "oil plan today"), ("a", 2, "u2", "oil ministry plan")], "source_id string, place int, url string, title string")
    found = discovery.recovered(items, sources, index)
    assert {(r.item_id, r.url, r.similarity) for r in found.collect()} == {("i0", "u2", 1.0), ("i1", "u2", 1.0), ("i2", "u1", 0.6167)} and found.count() == 3
    assert "share" in found._jdf.queryExecution().optimizedPlan().toString()


def test_forms_are_folded_once_for_all_profiles(spark, tmp_path):
    texts = ["ﷲ ① Ａｂｃ\u200f «x»\tإِعْلَانُ ﬁ", "plain", "", None, "أ\u06d6ﷲ\ufeff ﻻ-ﻻ"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = PLANS["text_normalize_forms"](spark, str(tmp_path))
    profiles = ("scope", "routing", "origin", "glossary")
    want = spark.read.parquet(str(tmp_path / "documents.parquet")).select("doc_id", *(text.normalize(F.col("text"), p).alias(p) for p in profiles))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("_nfkc(") == 1
