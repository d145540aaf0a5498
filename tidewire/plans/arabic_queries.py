"""The rules of the Arabic news profile over fixed Arabic reports, as the driver's tables hold none."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import lexicon, text
from tidewire.operators import arabic_rules, discovery, events, profiles, records, rules, similarity, titles
from tidewire.plans.fixed import copied, dealt, per_copy, per_document
from tidewire.plans.fixed import values as fixed
from tidewire.plans.registry import query

FILL = " تفاصيل متكررة عن الموضوع نفسه" * 20
REPORT = "id string, category string, title string, body string"

_GATE = [
    ("project", "security", "حريق يتسبب بتعطيل العمل في بسماية", "نص", "keep", "bismayah", "PRIORITY_SUBJECT"),
    ("short", "economy", "خبر", FILL, "drop", "economy", "TITLE_TOO_SHORT"),
    ("sport", "economy", "منتخب العراق يستعد لمباراة كرة القدم المقبلة", FILL, "drop", "economy", "NOISE"),
    ("economy", "economy", "العراق يعلن عن مشاريع سكنية في ميسان", FILL, "keep", "economy", "SIGNAL"),
    ("abroad", "economy", "السعودية تعلن عقود نفط مع شركات عالمية", "تقرير عن السعودية." + FILL * 3 + " العراق", "drop", "economy", "FOREIGN_TITLE"),
    ("nowhere", "politics", "اجتماع حكومي جديد لمناقشة الملفات", FILL, "drop", "politics", "NO_HOME_EVIDENCE"),
    ("no signal", "security", "العراق ينظم معرضا للزهور في بغداد", FILL, "drop", "security", "NO_CATEGORY_SIGNAL"),
    ("trade", "international", "العراق وعمان يناقشان التبادل التجاري والاستثمارات", FILL, "keep", "economy", "REROUTED"),
    ("border", "international", "العراق وتركيا يناقشان التعاون الامني وضبط الحدود", FILL, "keep", "security", "REROUTED"),
    ("visit", "international", "العراق وتركيا يناقشان العلاقات الثنائية", FILL, "keep", "politics", "REROUTED"),
    ("market", "international", "أسعار النفط تقفز مع القلق على مضيق هرمز", FILL, "keep", "international", "MARKET_LINK"),
    ("no market", "international", "سفن تتوقف قرب باب المندب بعد هجوم الحوثيين", FILL, "drop", "international", "NO_MARKET_LINK"),
    ("other", "weather", "العراق يسجل درجات حرارة مرتفعة", FILL, "drop", "weather", "UNKNOWN_CATEGORY"),
    ("null", None, None, None, "drop", None, "TITLE_TOO_SHORT"),
]


@query(per_document("id VARCHAR, action VARCHAR, category VARCHAR, reason VARCHAR", [(r[0], *r[4:]) for r in _GATE]))
def arabic_strict_gate(spark, d):
    return arabic_rules.strict_gate(dealt(spark, d, [r[:4] for r in _GATE], REPORT)).select("doc_id", "id", "gate.action", "gate.category", "gate.reason")


_GATE_KEYWORD = [("kept", "economy", "خبر موجز عن المدينة", "نص", "bismayah-001", None, "PRIORITY_SUBJECT"), ("read", "economy", "خبر موجز عن المدينة", "نص", "bismayah-001", "FULL_TEXT", "NO_HOME_EVIDENCE")]


@query(per_document("id VARCHAR, reason VARCHAR", [(r[0], r[6]) for r in _GATE_KEYWORD]))
def arabic_gate_by_keyword(spark, d):
    rows = dealt(spark, d, [r[:6] for r in _GATE_KEYWORD], REPORT + ", keyword_id string, content_status string")
    return arabic_rules.strict_gate(rows).select("doc_id", "id", "gate.reason")


_ROUTE = [
    ("partners", "international", "تركيا والعراق يوقعان وثيقة شراكة استراتيجية", "بحث رئيس الوزراء العراقي العلاقات الثنائية" + FILL, "politics", True, "direct-iraq-government-or-diplomatic-affairs"),
    ("trade", "international", "العراق وعمان يناقشان رفع التبادل التجاري", "ناقش الجانبان الاستثمار والطاقة والنقل" + FILL, "economy", True, "direct-iraq-economic-headline"),
    ("border", "international", "العراق وتركيا ينسقان أمن الحدود ومكافحة الإرهاب", "التنسيق العسكري ومكافحة داعش" + FILL, "security", True, "direct-iraq-security-headline"),
    ("market", "international", "القلق على مضيق هرمز يدفع أسعار النفط العالمية", "ارتفعت أسعار برنت" + FILL, "international", False, "external-international-context"),
    ("home", "economy", "العراق يصدر النفط", FILL, "economy", False, "not-international"),
    ("null", None, None, None, "", False, "not-international"),
]


@query(per_document("id VARCHAR, category VARCHAR, direct BOOLEAN, reason VARCHAR, label VARCHAR, section VARCHAR", [
    (*(r[0], *r[4:]), records.ROUTE_LABELS.get(r[6], r[6]), records.SECTIONS.get(r[4], "politicsItems")) for r in _ROUTE]))
def arabic_direct_route(spark, d):
    routed = arabic_rules.direct_route(dealt(spark, d, [r[:4] for r in _ROUTE], REPORT)).select("doc_id", "id", "route.category", "route.direct", "route.reason")
    return routed.withColumns({"label": records.route_label(F.col("reason")), "section": records.section_of(F.col("category"))})


_OVERRIDE = [
    ("bank", "politics", "المصارف العراقية تبدأ تطبيق متطلبات الامتثال", "في بغداد", "economy", "IRAQI_BANKING_AND_FINANCIAL_REGULATION"),
    ("turkey", "politics", "العلاقات العراقية التركية ومستقبل التبادل التجاري", "", "economy", "IRAQ_TURKEY_ECONOMIC_STRATEGIC_PARTNERSHIP"),
    ("position", "security", "العراق يدين القصف", "", "politics", "IRAQI_OFFICIAL_DIPLOMATIC_POSITION"),
    ("none", "security", "انفجار في الموصل", None, "security", None),
]


@query(per_document("id VARCHAR, category VARCHAR, rule VARCHAR", [(r[0], *r[4:]) for r in _OVERRIDE]))
def arabic_category_override(spark, d):
    return arabic_rules.category_override(dealt(spark, d, [r[:4] for r in _OVERRIDE], REPORT)).select("doc_id", "id", "override.category", "override.rule")


_VALID = [
    ("project", "bismayah", "العمل في بسماية", "", None), ("inside", "bismayah", "العمل في ببسمايةت", "", "NON_IRAQ_RELATED"), ("builder", "bismayah", "شركة هانوا تعود", "إلى العراق", None),
    ("ceremony", "politics", "رئيس الوزراء يوجه تهنئة", "قرار", "CEREMONIAL_POLITICS"), ("anchors", "politics", "قرار جديد", "", "NON_IRAQ_RELATED"),
    ("poor", "politics", "مجلس النواب", "خبر", "LOW_INFORMATION_POLITICS"), ("fine", "politics", "مجلس النواب", "تصويت على قانون", None),
    ("prices", "economy", "أسعار الخضروات في العراق", "عقود", "LOW_RELEVANCE_ECONOMY"), ("thin", "economy", "خبر من بغداد", "", "LOW_INFORMATION_ECONOMY"), ("built", "economy", "مشروع في بغداد", "", None),
    ("foreign", "security", "انفجار في سوريا", "", "FOREIGN_SECURITY_EVENT"), ("unplaced", "security", "انفجار كبير", "", "NON_IRAQ_RELATED"),
    ("calm", "security", "أجواء هادئة في كركوك", "", "LOW_INFORMATION_SECURITY"), ("bomb", "security", "انفجار في كركوك", None, None), ("world", "international", None, None, None),
]


@query(per_document("id VARCHAR, error_code VARCHAR, status VARCHAR", [(r[0], r[4], "FAILED" if r[4] else "FULL_TEXT") for r in _VALID]))
def arabic_validation(spark, d):
    """What fetched reports must show, and the content status that follows for a long enough Arabic text with a URL."""
    checked = arabic_rules.validated(dealt(spark, d, [r[:4] for r in _VALID], REPORT))
    status = rules.hydration(F.lit("https://a.example/1"), F.lit(400), F.lit(0.9), F.col("error_code").isNull())
    return checked.select("doc_id", "id", "error_code", status.alias("status"))


_SCORED = [
    ("project", "bismayah", "شركة هانوا تعود إلى مشروع بسماية", "قرار مجلس الوزراء بشأن مستحقات العقد" + FILL, "u", "شفق نيوز", None, 88, "IMPORTANT", 8),
    ("economy", "economy", "مشروع سكني", "عقد بقيمة مليار" + FILL, "u", "x", None, 24, "LOW", 6),
    ("copy", "economy", "مشروع سكني", "عقد بقيمة مليار" + FILL, "u", "x", False, 9, "LOW", 6),
    ("bare", "politics", "خبر", "", "", "", None, 0, "LOW", 1), ("none", None, None, None, None, None, None, 0, "LOW", 1),
]


@query(per_document("id VARCHAR, score INT, level VARCHAR, reliability INT", [(r[0], *r[7:]) for r in _SCORED]))
def arabic_importance(spark, d):
    rows = dealt(spark, d, [r[:7] for r in _SCORED], REPORT + ", url string, source string, is_representative boolean")
    return arabic_rules.importance(rows).select("doc_id", "id", "importance.score", "importance.level", F.element_at("importance.breakdown", F.lit("source_reliability")).alias("reliability"))


_PROMOTED = [("a", "economy", 5, True, "bismayah", 100), ("b", "economy", 120, True, "bismayah", 120), ("c", "economy", 7, None, "economy", 7)]


@query(per_document("id VARCHAR, category VARCHAR, priority INT", [(r[0], *r[4:]) for r in _PROMOTED]))
def arabic_promotion(spark, d):
    rows = dealt(spark, d, [r[:4] for r in _PROMOTED], "id string, category string, priority int, priority_match boolean")
    return arabic_rules.promoted(rows).select("doc_id", "id", "category", "priority")


_FLOORS = [
    ("direct", "اتفاق بين بسماية وشركة هانوا والهيئة الوطنية للاستثمار", "", 98, "BISMAYAH_NIC_HANWHA_DIRECT"),
    ("decision", "مجلس الوزراء يصدر قرار بشأن بسماية", "", 95, "BISMAYAH_GOVERNMENT_DECISION"),
    ("payment", "هانوا تطالب بتسديد مستحقات", "", 95, "BISMAYAH_CONTRACT_PAYMENT_EXECUTION"),
    ("chair", "تعيين رئيس الهيئة الوطنية للاستثمار", "", 90, "NIC_CHAIR_PERSONNEL_CHANGE"), ("plain", "سكان بسماية", "", 90, "DIRECT_BISMAYAH"),
    ("policy", "الهيئة الوطنية للاستثمار تعدل قانون الاستثمار", "", 80, "NIC_POLICY_ORGANIZATION"), ("housing", "مشروع سكني في بغداد", "", 65, "IRAQ_HOUSING_GENERAL"),
    ("stalled", "مجلس النواب يرفع توصيات عن مشاريع متوقفة", "economy", 72, "ECONOMY_STALLED_PROJECT_OVERSIGHT"), ("everywhere", "مجلس النواب يرفع توصيات عن مشاريع متوقفة في جميع المحافظات", "economy", 78, "ECONOMY_NATIONAL_STALLED_PROJECT_OVERSIGHT"),
    ("none", "طقس معتدل", "", 0, "NONE"),
]


@query(per_document("id VARCHAR, score INT, rule VARCHAR", [(r[0], *r[3:]) for r in _FLOORS]))
def arabic_floors(spark, d):
    rows = dealt(spark, d, [r[:3] for r in _FLOORS], "id string, text string, category string")
    made = rows.select("doc_id", "id", "category", profiles.business_floor(F.col("text"), F.col("text")).alias("b"), profiles.category_floor(F.col("category"), F.col("text")).alias("c"))
    best = F.when(F.col("c.score") > F.col("b.score"), F.col("c")).otherwise(F.col("b"))
    return made.select("doc_id", "id", best["score"].alias("score"), best["rule"].alias("rule"))


_SCOPE = [
    ("abroad", "security", "مسلحون يهاجمون قرية في نيجيريا", "تفاصيل الهجوم", "FOREIGN_SECURITY_PRIMARY_TITLE"), ("home", "security", "اعتقال مطلوبين في واسط", "بيان", None),
    ("joined", "security", "حملة ضد الإرهاب بالعراق", "بيان", None), ("later", "security", "هجوم في سوريا", "يتابع العراق التطورات", "FOREIGN_SECURITY_PRIMARY_TITLE"),
    ("nowhere", "security", "اعتقال مطلوبين", "بيان", "NO_HOME_EVIDENCE"), ("free", "economy", "خبر", "نص", None),
]


@query(per_document("id VARCHAR, reason VARCHAR", [(r[0], r[4]) for r in _SCOPE]))
def arabic_scope(spark, d):
    rows = dealt(spark, d, [r[:4] for r in _SCOPE], REPORT)
    return rows.select("doc_id", "id", profiles.scope(F.col("category"), F.col("title"), F.col("body")).alias("reason"))


_AUDIT = [("leak", "انفجار في دمشق", "بيان", "SUSPECT"), ("linked", "انفجار في دمشق", "قال مصدر في بغداد", "REVIEWED"), ("home", "انفجار في البصرة", "بيان", None)]


@query(per_document("id VARCHAR, audit VARCHAR", [(r[0], r[3]) for r in _AUDIT]))
def arabic_audit(spark, d):
    rows = dealt(spark, d, [r[:3] for r in _AUDIT], "id string, title string, body string")
    return rows.select("doc_id", "id", profiles.audit(F.col("title"), F.col("body")).alias("audit"))


_TALKS = "ناقش التمثيل التجاري المصري والهيئة الوطنية للاستثمار سبل التعاون الاستثماري بين مصر والعراق"
_EVENTS = [
    (1, "10:00", "مصر والعراق يفتحان بابا للتعاون", _TALKS, None), (2, "12:00", "القاهرة وبغداد وحركة المستثمرين", _TALKS, None), (4, "23:00", "خبر قصير", "نفط", None),
    (5, "10:00", "تكليف عادل الياسري", "الهيئة الوطنية للاستثمار", None), (6, "22:00", "تعيين رئيس جديد", "عادل داخل الياسري رئيس هيئة الاستثمار الوطنية", None), (7, "11:00", "إعفاء عادل الياسري", "الهيئة الوطنية للاستثمار", None),
    (10, "08:00", "انفجار عبوة ناسفة يقتل 12 شخصا قرب المقدادية", "أعلنت الشرطة الحصيلة", "bombing"), (11, "09:00", "انفجار عبوة يوقع 12 قتيلا قرب المقدادية", "ذكر شهود تفاصيل مختلفة تماما", "bombing"),
    (12, "09:30", "انفجار عبوة يوقع 30 قتيلا قرب تلعفر", "رواية ثالثة بلا صلة", "bombing"),
]


def _features(spark, d):
    """Every document's copy of the reports, a category of its own."""
    rows = copied(spark, d, _EVENTS, "id bigint, t string, title string, body string, incident string", "id")
    articles = rows.select("id", F.floor(F.col("id") / 1000).cast("string").alias("category"), F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("published_at"), "title", "body", "incident")
    return articles, events.features(articles, arabic_rules.EVENT_LANGUAGE)


@query(per_copy("a BIGINT, b BIGINT, score DOUBLE", [(1, 2, 0.93), (5, 6, 0.96), (10, 11, 0.5646), (11, 12, 0.5851)], "a", "b"))
def arabic_event_pairs(spark, d):
    """Pairs by signals, actions, numbers and incident: sure matches, a conflict of acts (5, 7), a shared number (10, 11)."""
    return events.match_edges(_features(spark, d)[1], sure=arabic_rules.EVENT_SURE).select("a", "b", F.round("score", 4).alias("score"))


@query(per_copy("id BIGINT, component BIGINT", [(1, 1), (2, 1), (4, 4), (5, 5), (6, 5), (7, 7), (10, 10), (11, 10), (12, 10)], "id", "component"))
def arabic_event_groups(spark, d):
    articles, feats = _features(spark, d)
    return similarity.grouped(articles.select("id"), events.group_edges(feats, sure=arabic_rules.EVENT_SURE))


_PROFILES = "إِعْلَانُ  «النفط»‏ على ﷲ ① Abc 30"
_NORMAL = [
    ("plain", "اعلان «النفط»‏ علي ﷲ ① Abc 30"), ("lower", "اعلان «النفط»‏ علي ﷲ ① abc 30"), ("content", "اعلان «النفط» علي ﷲ ① abc 30"), ("event", "اعلان النفط علي 30"), ("index", "اعلان النفط علي ﷲ ① Abc 30"),
    ("routing", "اعلان «النفط»‏ علي الله 1 abc 30"), ("origin", "اعلان النفط علي الله 1 abc 30"), ("glossary", "اعلان «النفط»‏ علي الله 1 abc 30"),
]


@query("SELECT doc_id, cases.* FROM documents, (" + fixed("profile VARCHAR, text VARCHAR", _NORMAL) + ") cases")
def arabic_normalize(spark, d):
    rows = dealt(spark, d, [(_PROFILES,)], "t string")
    every = F.array(*(F.struct(F.lit(p).alias("profile"), text.normalize(F.col("t"), p).alias("text")) for p, _ in _NORMAL))
    return rows.select("doc_id", F.explode(every).alias("p")).select("doc_id", "p.profile", "p.text")


_RATIO = [("ab", 0.0), ("نفط", 1.0), ("نفط abc", 0.5), ("", 0.0)]


@query(per_document("text VARCHAR, ratio DOUBLE", _RATIO))
def arabic_ratio(spark, d):
    return dealt(spark, d, [r[:1] for r in _RATIO], "text string").select("doc_id", "text", text.script_ratio(F.col("text")).alias("ratio"))


_WORDS = [("بالعراق", "عراق"), ("للنفط", "نفط"), ("والنفط", "نفط"), ("العراق", "عراق"), ("نفط", "نفط")]


@query(per_document("word VARCHAR, bare VARCHAR", _WORDS))
def arabic_canonical_words(spark, d):
    return dealt(spark, d, [r[:1] for r in _WORDS], "word string").select("doc_id", "word", text.canonical_token(F.col("word")).alias("bare"))


_SUBJECT = [("في بسماية", "x", True), ("هانوا في العراق", "x", True), ("هانوا في كوريا", "x", False), ("الهيئة الوطنية للاستثمار", "nic", True), ("الهيئة الوطنية للاستثمار", "x", False), ("خبر", "nic", False)]


@query(per_document("text VARCHAR, source_id VARCHAR, priority BOOLEAN", _SUBJECT))
def arabic_priority_subject(spark, d):
    rows = dealt(spark, d, [r[:2] for r in _SUBJECT], "text string, source_id string")
    return rows.select("doc_id", "text", "source_id", arabic_rules.priority_subject(F.col("text"), F.col("source_id")).alias("priority"))


_FOUND = [
    ("ceremony", "رئيس الوزراء يوجه برقية تهنئة", None, None, None, None, True, False), ("keyword", "خبر عن المهرجان", "نص", ["مهرجان"], "https://a.example", "صحيفة", True, False),
    ("plain", "خبر عن النفط", "نص", ["", "مهرجان"], "https://www.facebook.com/x", "صفحة", False, True), ("x", "خبر", None, [], "", "أخبار x.com", False, True), ("near x", "خبر", None, None, "https://netx.com", "", False, False),
]


@query(per_document("id VARCHAR, ceremonial BOOLEAN, social BOOLEAN", [(r[0], *r[6:]) for r in _FOUND]))
def discovery_rejects(spark, d):
    rows = dealt(spark, d, [r[:6] for r in _FOUND], "id string, title string, description string, excluded array<string>, homepage string, source string")
    return rows.select("doc_id", "id", discovery.ceremonial(F.col("title"), F.col("description"), F.col("excluded")).alias("ceremonial"), discovery.social(F.col("homepage"), F.col("source")).alias("social"))


_TITLES = [
    ("fine", "العراق يعلن مشروعا جديدا", "https://a.example/1", True, "العراق يعلن مشروعا جديدا"), ("short", "خبر", "https://a.example/1", False, "خبر"), ("latin", "Only Latin letters here", "https://a.example/1", False, "Only Latin letters here"),
    ("section", "آخر الأخبار من بغداد اليوم", "https://a.example/1", False, "آخر الأخبار من بغداد اليوم"), ("mail", "someone@example.org", None, False, "someone@example.org"), ("null", None, None, False, ""),
    ("site", "العراق يعلن مشروعا - شفق نيوز | كل الأخبار", "https://www.shafaq.com/ar/1", True, "العراق يعلن مشروعا"), ("elsewhere", "العراق يعلن مشروعا - شفق نيوز", "https://a.example/1", True, "العراق يعلن مشروعا - شفق نيوز"),
    ("slogan", "العراق يعلن مشروعا | آخر الأخبار في العراق والعالم", "https://a.example/1", False, "العراق يعلن مشروعا"), ("marks", "العراق&rlm; يعلن <b>مشروعا</b> جديدا", "", True, "العراق يعلن مشروعا جديدا"),
]


@query(per_document("id VARCHAR, usable BOOLEAN, cleaned VARCHAR", [(r[0], *r[3:]) for r in _TITLES]))
def title_usable(spark, d):
    rows = dealt(spark, d, [r[:3] for r in _TITLES], "id string, title string, url string")
    return rows.select("doc_id", "id", titles.usable(F.col("title")).alias("usable"), titles.cleaned(F.col("title"), F.col("url")).alias("cleaned"))


_LD = '<script type="application/ld+json">{}</script>'
_NEWS, _OTHER = '{"@graph":[{"@type":"WebPage","name":"صفحة من صفحات الموقع"},{"@type":["NewsArticle"],"headline":"وزارة النفط تعلن خطة جديدة"}]}', '{"@type":"Person","name":"اسم شخص ليس عنوانا هنا"}'
_REPAIRS = [
    ("kept", "عنوان صالح للاستعمال هنا", "<h1>عنوان آخر صالح للاستعمال</h1>", "عنوان صالح للاستعمال هنا", None, "عنوان آخر صالح للاستعمال"),
    ("node", "خبر", _LD.format(_NEWS) + "<h1>عنوان آخر صالح للاستعمال</h1>", "وزارة النفط تعلن خطة جديدة", "JSON_LD_HEADLINE", "وزارة النفط تعلن خطة جديدة"),
    ("heading", "الرئيسية", _LD.format(_OTHER) + "<h1>قصير</h1><h1>هذا هو العنوان الأطول في الصفحة</h1>", "هذا هو العنوان الأطول في الصفحة", "ARTICLE_H1", "قصير"),
    ("og", None, '<meta property="og:title" content="عنوان من بيانات الصفحة">', "عنوان من بيانات الصفحة", "OG_TITLE", "عنوان من بيانات الصفحة"),
    ("twitter", "a@b.example", '<meta name="twitter:title" content="عنوان آخر من البيانات"><meta property="og:title" content="قصير">', "عنوان آخر من البيانات", "TWITTER_TITLE", "قصير"),
    ("none", "خبر", "<p>لا شيء</p>", "خبر", None, "خبر"), ("no page", "خبر", None, "خبر", None, "خبر"), ("broken", "خبر", _LD.format("{not json"), "خبر", None, "خبر"),
]


@query(per_document("id VARCHAR, title VARCHAR, method VARCHAR, elected VARCHAR", [(r[0], *r[3:]) for r in _REPAIRS]))
def title_repair(spark, d):
    """Unusable titles from their own pages, and the title a first extraction elects."""
    rows = dealt(spark, d, [r[:3] for r in _REPAIRS], "id string, title string, html string")
    found = rows.withColumn("elected", titles.elected(F.coalesce("html", F.lit("")), F.col("title"), F.lit("")))
    return titles.repaired(found).select("doc_id", "id", "title", "method", "elected")


_LONG = "هذا نص أطول من غيره في هذه الصفحة"
_BODIES = [
    ("json", _LD.format('{"@type":"NewsArticle","articleBody":"' + _LONG + '","description":"قصير"}') + "<article>قصير</article>", _LONG),
    ("class", f'<div class="post entry-content"><p>{_LONG}</p></div><main>قصير</main>', _LONG), ("article", f"<article><script>x</script><b>{_LONG}</b></article>", _LONG),
    ("meta", f'<meta name="description" content="{_LONG}"><p>خارج</p>', _LONG), ("rights", f"<article>{_LONG} جميع الحقوق محفوظة لدى الموقع</article>", _LONG), ("none", "<p>خارج</p>", ""),
]


@query(per_document("id VARCHAR, body VARCHAR", [(r[0], r[2]) for r in _BODIES]))
def best_body(spark, d):
    return dealt(spark, d, [r[:2] for r in _BODIES], "id string, html string").select("doc_id", "id", titles.best_body(F.col("html")).alias("body"))


_LD_PAGES = [("one", _LD.format(_NEWS)), ("bad", _LD.format("{") + _LD.format('[{"@type":"Article","headline":"h"}]')), ("none", "<p></p>")]


@query(per_copy("page VARCHAR, pos INT, type VARCHAR, headline VARCHAR, name VARCHAR", [
    ("one", 0, None, None, None), ("one", 1, "WebPage", None, "صفحة من صفحات الموقع"), ("one", 2, "NewsArticle", "وزارة النفط تعلن خطة جديدة", None), ("bad", 0, "Article", "h", None)], "page"))
def json_ld_fixed_pages(spark, d):
    from tidewire.sources import html

    rows = copied(spark, d, _LD_PAGES, "page string, html string", "page")
    return rows.select("page", F.posexplode(html.json_ld(F.col("html"))).alias("pos", "n")).select("page", "pos", "n.type", "n.headline", "n.name")



_SEEDS = [
    ("fine", None, True, "bismayah", "u", "بسماية", "نص عربي " * 50, True), ("off", False, True, "bismayah", "u", "بسماية", "نص عربي " * 50, False), ("not allowed", True, None, "bismayah", "u", "بسماية", "نص عربي " * 50, False),
    ("category", True, True, "economy", "u", "بسماية", "نص عربي " * 50, False), ("short", True, True, "bismayah", "u", "بسماية", "نص", False), ("latin", True, True, "bismayah", "u", "x", "latin text " * 50, False), ("no url", True, True, "bismayah", None, "بسماية", "نص عربي " * 50, False),
]


@query(per_document("id VARCHAR, valid BOOLEAN", [(r[0], r[7]) for r in _SEEDS]))
def seed_validity(spark, d):
    rows = dealt(spark, d, [r[:7] for r in _SEEDS], "id string, enabled boolean, allowed boolean, category string, url string, title string, text string")
    return rows.select("doc_id", "id", records.seed_valid(*(F.col(c) for c in ("enabled", "allowed", "category", "url", "title", "text"))).alias("valid"))


_KEYWORDS = [("k1", "نفط"), ("k1", "غاز"), ("k2", "oil"), ("k3", None), ("k4", "سكن")]


@query(per_copy("rule VARCHAR, id VARCHAR", [("DUPLICATE_ID", "k1"), ("NO_ARABIC_QUERY", "k2"), ("NO_ARABIC_QUERY", "k3")], "id"))
def config_problems(spark, d):
    return records.keyword_problems(copied(spark, d, _KEYWORDS, "keyword_id string, query string", "keyword_id"))


_GLOSSARY = [("a", "رئيس الوزراء العراقي يزور بغداد", True, False), ("b", "وزراء", False, False), ("c", "the nic said", False, True), ("d", "picnic", False, False)]


@query(per_document("id VARCHAR, token BOOLEAN, acronym BOOLEAN", [(r[0], *r[2:]) for r in _GLOSSARY]))
def arabic_tokens_and_acronyms(spark, d):
    rows = dealt(spark, d, [r[:2] for r in _GLOSSARY], "id string, text string")
    return rows.select("doc_id", "id", lexicon.exact_token(F.col("text"), "بغداد").alias("token"), lexicon.acronym(F.col("text"), "nic").alias("acronym"))


_MATCHES = [("i1", "https://news.a.example/", "وكالة", "وزارة النفط تعلن خطة جديدة للإنتاج"), ("i2", "", "صحيفة الشرق", "وزارة النفط تعلن خطة جديدة للإنتاج"), ("i3", "https://c.example", "أخرى", "وزارة النفط تعلن خطة جديدة للإنتاج"), ("i4", "https://a.example", "", "شيء مختلف تماما")]
_SOURCES = [("a", ["a.example"], ["الوكالة الأولى"]), ("b", ["b.example"], ["الشرق"])]
_INDEX = [("a", 1, "https://a.example/1", "خطة جديدة لوزارة النفط"), ("a", 2, "https://a.example/2", "وزارة النفط تعلن خطة جديدة للإنتاج النفطي"), ("b", 1, "https://b.example/9", "وزارة النفط تعلن خطة جديدة للإنتاج")]


@query(per_copy("item_id VARCHAR, source_id VARCHAR, url VARCHAR, similarity DOUBLE", [("i1", "a", "https://a.example/2", 0.9571), ("i2", "b", "https://b.example/9", 1.0)], "item_id"))
def source_recovery(spark, d):
    """Title recovery at 0.54 among the index entries of the sources that an item belongs to."""
    items = copied(spark, d, _MATCHES, "item_id string, homepage string, source string, title string", "item_id")
    sources = spark.createDataFrame(_SOURCES, "source_id string, hosts array<string>, names array<string>")
    return discovery.recovered(items, sources, spark.createDataFrame(_INDEX, "source_id string, place int, url string, title string"))
