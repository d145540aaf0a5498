"""The Arabic news profile: fixed values that the rules take as parameters. Other corpora pass their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.lexicon import acronym, any_of
from tidewire.functions.text import PROFILES, Profile, normalize
from tidewire.operators.rules import category_alias, floor_of, ladder

# Names that place a report in the home country.
HOME_SCOPE = [
    "العراق", "العراقي", "العراقية", "عراقي", "عراقية", "بغداد", "البصرة", "الموصل", "كركوك", "الانبار", "أربيل", "اربيل", "السليمانية",
    "كربلاء", "النجف", "ديالى", "صلاح الدين", "نينوى", "ذي قار", "ميسان", "واسط", "بابل", "الديوانية", "المثنى", "دهوك", "كردستان العراق",
    "الحكومة العراقية", "مجلس الوزراء العراقي", "مجلس النواب العراقي", "البرلمان العراقي", "القوات العراقية", "الجيش العراقي", "الشرطة العراقية",
    "الحشد الشعبي", "جهاز مكافحة الارهاب", "جهاز الامن الوطني", "قيادة العمليات المشتركة", "وزارة الداخلية العراقية", "وزارة الدفاع العراقية",
]
# Places abroad whose security reports are out of scope.
FOREIGN_SCOPE = [
    "نيجيريا", "النيجيري", "النيجيرية", "سوكوتو", "سوريا", "السوري", "السورية", "لبنان", "اللبناني", "اللبنانية", "فلسطين", "الفلسطيني", "الفلسطينية",
    "غزة", "ايران", "الايراني", "الايرانية", "اليمن", "اليمني", "اليمنية", "السعودية", "السعودي", "مصر", "المصري", "الاردن", "الكويت", "قطر",
    "الامارات", "البحرين", "تركيا", "التركي", "افغانستان", "باكستان", "الهند", "كينيا", "الصومال", "السودان", "المغرب", "تونس", "الجزائر", "كولومبيا",
]
# Of the audit of local reports.
FOREIGN_AUDIT = [
    "سوريا", "السوري", "السورية", "درعا", "حماة", "حمص", "حلب", "دمشق", "لبنان", "اللبناني", "اللبنانية", "بيروت", "فلسطين", "الفلسطيني", "الفلسطينية",
    "قطاع غزة", "غزة", "ايران", "الايراني", "الايرانية", "طهران", "اليمن", "اليمني", "اليمنية", "صنعاء", "السعودية", "السعودي", "جدة", "الرياض", "ينبع",
    "مصر", "المصري", "المصرية", "القاهرة", "الاردن", "الاردني", "الاردنية", "الكويت", "الكويتي", "الكويتية", "قطر", "القطري", "القطرية", "الامارات",
    "الاماراتي", "الاماراتية", "دبي", "البحرين", "البحريني", "البحرينية", "عمان", "العماني", "العمانية", "تركيا", "التركي", "التركية", "باكستان",
    "افغانستان", "الهند", "المغرب", "تونس", "الجزائر", "السودان",
]
HOME_AUDIT = [
    "العراق", "العراقي", "العراقية", "عراقي", "عراقية", "بغداد", "البصرة", "الموصل", "كركوك", "الانبار", "اربيل", "السليمانية", "كربلاء", "النجف", "ديالى",
    "صلاح الدين", "نينوى", "ذي قار", "ميسان", "واسط", "بابل", "الديوانية", "المثنى", "دهوك", "كردستان العراق", "الحكومة العراقية", "مجلس الوزراء العراقي",
    "مجلس النواب العراقي", "البرلمان العراقي", "وزارة الاعمار والاسكان", "وزارة الاعمار والاسكان والبلديات العامة",
    "وزارة الاعمار والاسكان والبلديات والاشغال العامة", "دائرة الطرق والجسور", "وزارة التخطيط العراقية", "وزارة النفط العراقية", "البنك المركزي العراقي",
    "الهيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "بسماية", "بسمايه", "مدينة بسماية الجديدة", "مشروع بسماية", "شركة هانوا",
    "iraq", "iraqi", "bismayah", "bismaya", "bncp", "hanwha",
]
EXCEPTIONS_AUDIT = ["جسر غزة"]

# Subjects of the business floors.
BISMAYAH = ["بسماية", "مدينة بسماية الجديدة", "مشروع بسماية", "bismayah", "비스마야", "비스마야 신도시"]
HANWHA = ["شركة هانوا", "هانوا", "hanwha", "한화", "한화건설", "한화 건설"]
NIC = ["الهيئة الوطنية للاستثمار", "هيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "national investment commission", "국가투자위원회", "이라크 국가투자위원회"]
NIC_CHAIR = ["رئيس الهيئة الوطنية للاستثمار", "رئيس هيئة الاستثمار الوطنية", "رئاسة الهيئة الوطنية للاستثمار", "chairman of the national investment commission", "national investment commission chairman", "nic chairman", "nic chair", "국가투자위원회 의장", "국가투자위원장", "nic 의장", "nic 위원장"]
CHAIR = ["رئيس", "رئاسة", "chairman", "chair", "head", "의장", "위원장"]
PERSONNEL = ["تعيين", "تكليف", "إقالة", "إعفاء", "استبدال", "استقالة", "appointed", "appointment", "named", "dismissed", "removed", "replacement", "resigned", "임명", "선임", "해임", "면직", "교체", "사임"]
DECISION = ["قرار", "توجيه", "تصويت", "قانون", "مرسوم", "اتفاق", "إقرار", "اعتماد", "تنفيذ", "تخصيص", "تمويل", "إقالة", "إعفاء", "تعيين", "تكليف", "결정", "지시", "승인", "의결", "임명", "해임", "교체", "appointment", "approved", "decision"]
GOVERNMENT = ["رئيس الوزراء", "مجلس الوزراء", "مكتب رئيس الوزراء", "prime minister", "council of ministers", "cabinet", "총리", "국무회의", "총리실"]
CONTRACT = ["استئناف المشروع", "استكمال المشروع", "العقد", "عقود", "مستحقات", "دفعات", "تمويل", "ضمان", "خطاب ضمان", "تنفيذ", "تسليم", "صندوق التقاعد", "contract", "payment", "funding", "finance", "guarantee", "resume", "restart", "relaunch", "미수금", "대금", "지급", "금융", "자금", "보증", "계약", "사업 재개", "공사 재개", "프로젝트 재개", "이행보증"]
POLICY = ["قانون الاستثمار", "تعليمات", "صلاحيات", "هيكل", "إعادة هيكلة", "مجلس إدارة", "سياسة الاستثمار", "investment law", "regulation", "authority", "restructuring", "organization", "투자법", "시행규칙", "권한", "조직개편", "정책", "위원회 구성"]
HOUSING = ["مشروع سكني", "مشاريع سكنية", "وحدات سكنية", "مدن جديدة", "مدينة سكنية", "الإسكان", "housing project", "housing units", "new city", "주택사업", "주거도시", "신도시", "주택 건설"]
COUNTRY = ["العراق", "العراقي", "بغداد", "iraq", "iraqi", "baghdad", "이라크", "바그다드"]

# Of the floors for stalled projects.
STALLED = ["المشاريع المتلكئة", "مشاريع متلكئة", "المشاريع المتوقفة", "مشاريع متوقفة", "تعثر المشاريع", "المشاريع المتعثرة", "توقف المشاريع", "العقود المتوقفة", "지연 사업", "중단 사업", "사업 지연", "사업 정상화"]
AUTHORITY = ["البرلمان", "مجلس النواب", "مجلس الوزراء", "رئيس الوزراء", "وزارة التخطيط", "لجنة الخدمات والاعمار", "لجنة الاقتصاد والاستثمار", "لجنة الاستثمار والتنمية", "의회", "국회", "국무회의", "총리", "기획부"]
ACTION = ["فتح ملف", "يفتح ملف", "بحث ملف", "مناقشة ملف", "تحقيق", "استضافة", "استجواب", "لجنة تحقيق", "اعداد تقرير", "تقديم تقرير", "توصيات", "معالجة", "حسم", "공식 검토", "조사 착수", "현황 점검", "보고서 제출"]
NATIONWIDE = ["في العراق", "عموم العراق", "جميع المحافظات", "المشاريع الحكومية", "المشاريع الوطنية", "이라크 전역", "국가 사업", "정부 사업"]
# Names of the categories in stored data.
CATEGORY_ALIASES = {
    "bismayah": ["bismayah", "비스마야", "بسماية"],
    "politics": ["politics", "political", "정치", "정국", "정국/정치", "السياسة", "سياسة"],
    "economy": ["economy", "economic", "construction", "economy/construction", "economy & construction", "경제/건설", "경제·건설", "경제 건설", "경제", "건설", "الاقتصاد", "اقتصاد", "الاعمار", "اعمار"],
    "security": ["security", "안보", "치안", "치안/안보", "الامن", "أمن", "امن"],
    "international": ["international", "국제사회", "국제", "الدولية", "دولي"],
}
# The one aggregator whose article pages may stand in for a publisher's.
AGGREGATOR = ("hathalyoum.net", ["hathalyoum"], ["priority-source-index", "priority-aggregator-source-link", "PRIORITY_AGGREGATOR_FALLBACK"])


def norm(term: str, profile: str = "lower") -> str:
    """A term under a profile, as ``normalize`` would give it, for terms of letters and single blanks."""
    import re
    import unicodedata

    from tidewire.functions import text

    p: Profile = PROFILES[profile]
    term = unicodedata.normalize("NFKC", term) if p.nfkc else term
    term = re.sub(r"[ً-ٰٟـ]", "", term).translate(str.maketrans(text.LETTERS, text.LETTERS_AS))
    return term.lower() if p.lower else term


def normed(terms: list[str], profile: str = "lower") -> list[str]:
    return [norm(t, profile) for t in terms]


def scope(category: Column, title: Column, lead: Column, gated: str = "security") -> Column:
    """Scope gate of this profile; title and lead are raw."""
    from tidewire.operators.rules import scope_gate

    return scope_gate(category, normalize(title, "scope"), normalize(lead, "scope"), gated, normed(HOME_SCOPE, "scope"), normed(FOREIGN_SCOPE, "scope"))


def audit(title: Column, body: Column) -> Column:
    """Audit of local reports: null without a foreign place in the title, else SUSPECT or REVIEWED."""
    t, lead = normalize(title, "gate"), normalize(F.concat_ws("\n", title, F.substring(body, 1, 1600)), "gate")
    return F.when(any_of(t, normed(FOREIGN_AUDIT, "gate")), F.when(any_of(lead, normed(HOME_AUDIT, "gate")), "REVIEWED").otherwise("SUSPECT"))


# Codes of the floors and their scores, as stored data holds them.
BUSINESS_FLOORS = (
    ("BISMAYAH_NIC_HANWHA_DIRECT", 98),
    ("BISMAYAH_GOVERNMENT_DECISION", 95),
    ("BISMAYAH_CONTRACT_PAYMENT_EXECUTION", 95),
    ("NIC_CHAIR_PERSONNEL_CHANGE", 90),
    ("DIRECT_BISMAYAH", 90),
    ("NIC_POLICY_ORGANIZATION", 80),
    ("IRAQ_HOUSING_GENERAL", 65),
)
ECONOMY_FLOORS = (("ECONOMY_NATIONAL_STALLED_PROJECT_OVERSIGHT", 78), ("ECONOMY_STALLED_PROJECT_OVERSIGHT", 72))


def business_floor(text: Column, headline: Column) -> Column:
    """(score, rule) of the highest business floor; the first of equal ones."""
    t, h = normalize(text), normalize(headline)
    has = lambda terms, where=t: any_of(where, normed(terms))
    nic = has(NIC) | acronym(t, "nic")
    chair = has(NIC_CHAIR) | (nic & has(CHAIR, h))
    conditions = (
        has(BISMAYAH) & has(HANWHA) & nic, has(BISMAYAH) & has(GOVERNMENT) & has(DECISION), (has(BISMAYAH) | has(HANWHA)) & has(CONTRACT), nic & chair & has(PERSONNEL), has(BISMAYAH),
        nic & (has(POLICY) | has(DECISION)), has(HOUSING) & has(COUNTRY),
    )
    rules = [(condition, score, rule) for condition, (rule, score) in zip(conditions, BUSINESS_FLOORS, strict=True)]
    step = lambda score, rule: F.struct(F.lit(score).alias("score"), F.lit(rule).alias("rule"))
    return ladder(*((condition, step(score, rule)) for condition, score, rule in rules), otherwise=step(0, "NONE"))


def category_floor(category: Column, text: Column) -> Column:
    """(score, rule) of the floors for national bodies that take up stalled projects; only in the economy."""
    t = normalize(text)
    lexicons = ((STALLED, AUTHORITY, ACTION, NATIONWIDE), (STALLED, AUTHORITY, ACTION))
    floors = [(rule, score, [normed(x) for x in terms]) for (rule, score), terms in zip(ECONOMY_FLOORS, lexicons, strict=True)]
    none = F.struct(F.lit(0).alias("score"), F.lit(None).cast("string").alias("rule"))
    return F.when(canonical_category(category) == "economy", floor_of(t, floors)).otherwise(none)


def canonical_category(value: Column) -> Column:
    return category_alias(value, {name: [a.lower() for a in family] for name, family in CATEGORY_ALIASES.items()})
