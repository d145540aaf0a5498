"""Lexicons of the Arabic news rules: fixed values only; ``tidewire.operators.arabic_rules`` says what they are for."""

# Of the category gate.
HOME = [
    "العراق", "العراقي", "العراقية", "عراقي", "عراقية", "بغداد", "البصرة", "الموصل", "كركوك", "الانبار", "اربيل", "السليمانية", "كربلاء", "النجف",
    "ديالى", "صلاح الدين", "نينوى", "ذي قار", "ميسان", "واسط", "بابل", "الديوانية", "المثنى", "دهوك", "كردستان العراق", "iraq", "iraqi",
]
INSTITUTIONS = [
    "رئيس الوزراء العراقي", "رئيس مجلس الوزراء العراقي", "الحكومة العراقية", "مجلس الوزراء العراقي", "مجلس النواب العراقي", "البرلمان العراقي",
    "رئاسة الجمهورية العراقية", "وزارة الخارجية العراقية", "وزارة المالية العراقية", "وزارة التخطيط العراقية", "وزارة النفط العراقية",
    "وزارة الاعمار والاسكان", "وزارة الاعمار والاسكان والبلديات العامة", "وزارة الاعمار والاسكان والبلديات والاشغال العامة", "دائرة الطرق والجسور",
    "البنك المركزي العراقي", "القضاء العراقي", "المحكمة الاتحادية", "الاطار التنسيقي", "للاطار التنسيقي", "ائتلاف الاطار التنسيقي", "هيئة النزاهة",
    "الهيئة الوطنية للاستثمار", "القوات العراقية", "الجيش العراقي", "الشرطة العراقية", "جهاز الامن الوطني", "الحشد الشعبي", "عصائب اهل الحق", "العصائب",
    "كتائب حزب الله", "تحالف الفتح", "ائتلاف دولة القانون",
]
ACTORS = ["علي الزيدي", "الزيدي", "مكتب الزيدي", "محمد شياع السوداني", "السوداني", "نوري المالكي", "المالكي", "هادي العامري", "العامري", "قيس الخزعلي", "الخزعلي"]
PROJECT = ["بسماية", "بسمايه", "مدينة بسماية الجديدة", "مشروع بسماية", "bismayah", "bismaya", "bncp"]
BUILDER = ["شركة هانوا", "هانوا", "hanwha", "한화"]
COMMISSION = [
    "الهيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "رئيس الهيئة الوطنية للاستثمار", "national investment commission",
    "iraq national investment commission", "عادل الياسري", "عادل داخل الياسري", "حيدر مكية",
]
POLITICS = [
    "رئيس الوزراء", "مجلس الوزراء", "مجلس النواب", "البرلمان", "الاطار التنسيقي", "للاطار التنسيقي", "انتخابات", "تشكيل الحكومة", "تعيين", "تكليف",
    "اقالة", "استقالة", "تصويت", "جلسة", "قرار", "بيان", "اجتماع", "مباحثات", "زيارة رسمية", "وزارة الخارجية", "هيئة النزاهة", "المحكمة الاتحادية",
    "السيادة", "حصر السلاح بيد الدولة",
]
ECONOMY = [
    "اقتصاد", "استثمار", "استثمارات", "مشروع", "مشاريع", "اعمار", "اسكان", "سكني", "مدينة سكنية", "بنى تحتية", "عقد", "عقود", "تمويل", "قرض", "موازنة",
    "ميزانية", "مصرف", "مصارف", "البنك المركزي", "دولار", "تجارة", "تصدير", "استيراد", "نفط", "غاز", "طاقة", "كهرباء", "مطار", "مطارات", "طريق التنمية",
    "سكك حديد", "ميناء", "جمارك", "اعفاءات جمركية", "مقاولين", "مستحقات المقاولين", "المشاريع المتلكئة",
]
SECURITY = [
    "انفجار", "تفجير", "عبوة ناسفة", "لغم", "هجوم", "هجوم مسلح", "اطلاق نار", "اغتيال", "اشتباك", "قصف", "غارة", "صاروخ", "صواريخ", "طائرة مسيرة",
    "مسيّرات", "داعش", "ارهاب", "ارهابي", "عملية امنية", "اعتقال", "احباط هجوم", "قتل", "مقتل", "اصابة", "تظاهرة", "تظاهرات", "احتجاج", "احتجاجات",
    "متظاهرون", "اعتصام", "قطع الطريق", "اغلاق الطريق", "ساحة التحرير", "المنطقة الخضراء",
]
INTERNATIONAL = [
    "حرب ايران", "الحرب مع ايران", "ايران والولايات المتحدة", "ايران واسرائيل", "الولايات المتحدة وايران", "مضيق هرمز", "الخليج", "دول الخليج",
    "البحر الاحمر", "باب المندب", "الحوثي", "الحوثيين", "امن الملاحة", "ناقلات النفط", "طرق الشحن", "تصعيد اقليمي", "حرب اقليمية", "العقوبات الاميركية",
    "مفاوضات نووية", "اسعار النفط العالمية", "برنت", "خام برنت", "دبي الخام",
]
MARKET = ["مضيق هرمز", "هرمز", "اسعار النفط العالمية", "اسعار النفط", "سعر النفط العالمي", "سعر النفط", "برنت", "خام برنت", "دبي الخام", "ازمة النفط"]
OIL_ROUTE = ["تصدير النفط", "صادرات النفط", "طرق تصدير النفط", "ناقلات النفط", "امدادات النفط", "بدائل لتصدير النفط"]
ROUTE_PLACES = ["الخليج", "مضيق", "البحر الاحمر", "باب المندب", "قناة السويس", "الملاحة", "الشرايين"]
BILATERAL_ECONOMY = [
    "التبادل التجاري", "التجارة الثنائية", "حجم التجارة", "الاستثمارات المشتركة", "الاستثمار المشترك", "اتفاقيات اقتصادية", "اتفاقية اقتصادية",
    "اتفاقيات تجارية", "اتفاقية تجارية", "مذكرة تفاهم اقتصادية", "مجلس الاعمال", "رجال الاعمال", "منطقة حرة", "التعاون الاقتصادي", "التعاون التجاري",
    "التعاون الاستثماري", "التعاون في الطاقة", "التعاون في النقل", "المياه والطاقة", "الطاقة والمياه", "الممرات الاقتصادية", "الربط السككي",
    "الربط الكهربائي", "طريق التنمية", "النقل", "الزراعة", "الصناعة", "الجمارك", "النفط والغاز", "اعادة الاعمار",
]
BILATERAL_SECURITY = [
    "التعاون الامني", "اتفاق امني", "اتفاقية امنية", "مذكرة امنية", "امن الحدود", "ضبط الحدود", "التعاون العسكري", "اتفاق دفاعي", "التنسيق العسكري",
    "مكافحة الارهاب", "ملاحقة داعش", "القوات المسلحة", "الدفاع المشترك",
]
BILATERAL_POLITICS = [
    "العلاقات الثنائية", "الشراكة الاستراتيجية", "مجلس التعاون الاستراتيجي", "اتفاقية شراكة", "تعزيز العلاقات", "تطوير العلاقات", "التعاون الثنائي",
    "زيارة رسمية", "زيارة دولة", "لقاء ثنائي", "مباحثات رسمية", "وزيرا الخارجية", "وزير الخارجية", "السفير", "الدبلوماسية", "اتفاقيات متعددة",
    "اتفاقيات في مجالات متعددة", "ملفات مشتركة",
]
FOREIGN = [
    "سوريا", "السوري", "السورية", "درعا", "حماة", "حمص", "حلب", "دمشق", "لبنان", "اللبناني", "اللبنانية", "بيروت", "فلسطين", "الفلسطيني", "الفلسطينية",
    "غزة", "ايران", "الايراني", "الايرانية", "طهران", "اليمن", "اليمني", "اليمنية", "صنعاء", "السعودية", "السعودي", "جدة", "الرياض", "ينبع", "مصر",
    "المصري", "المصرية", "القاهرة", "الاردن", "الاردني", "الاردنية", "الكويت", "الكويتي", "الكويتية", "قطر", "القطري", "القطرية", "الامارات", "الاماراتي",
    "الاماراتية", "دبي", "البحرين", "البحريني", "البحرينية", "تركيا", "التركي", "التركية", "باكستان", "كشمير", "افغانستان", "كينيا", "الصومال",
    "كولومبيا", "المغرب", "تونس", "الجزائر", "السودان", "الهند",
]
FOREIGN_EXCEPTIONS = ["جسر غزة"]
NOISE = [
    "كرة القدم", "مباراة", "الدوري", "لاعب", "ريال مدريد", "برشلونة", "مسلسل", "فنان", "ممثلة", "اغنية", "ابراج", "حظك اليوم", "وصفة", "طبخ", "موضة",
    "اهم عناوين", "ملخص الاخبار", "نشرة الاخبار", "اخبار المغرب العاجلة",
]

# Of the router of international reports.
ROUTER_TITLE = [
    "العراق", "العراقي", "العراقية", "عراقي", "عراقية", "بغداد", "حكومة العراق", "الحكومة العراقية", "رئيس الوزراء العراقي", "رئيس مجلس الوزراء العراقي",
    "مجلس الوزراء العراقي", "مجلس النواب العراقي", "البرلمان العراقي", "وزارة الخارجية العراقية", "وزارة النفط العراقية", "وزارة التجارة العراقية",
    "وزارة التخطيط العراقية", "وزارة النقل العراقية", "البنك المركزي العراقي", "إقليم كردستان العراق", "اقليم كردستان العراق", "iraq", "iraqi", "이라크",
    "이라크 정부", "이라크 총리",
]
ROUTER_OPENING = [
    "الحكومة العراقية", "حكومة العراق", "رئيس الوزراء العراقي", "رئيس مجلس الوزراء العراقي", "مجلس الوزراء العراقي", "مجلس النواب العراقي",
    "البرلمان العراقي", "رئاسة الجمهورية العراقية", "وزارة الخارجية العراقية", "وزارة النفط العراقية", "وزارة التجارة العراقية", "وزارة التخطيط العراقية",
    "وزارة النقل العراقية", "وزارة الموارد المائية العراقية", "البنك المركزي العراقي", "الوفد العراقي", "مسؤولون عراقيون", "الجانب العراقي",
    "القوات العراقية", "الجيش العراقي", "إقليم كردستان العراق", "اقليم كردستان العراق", "이라크 정부", "이라크 총리", "이라크 대표단", "이라크 측", "이라크군",
]
ROUTER_POLITICS = [
    "رئيس الوزراء", "رئيس الجمهورية", "الحكومة", "مجلس الوزراء", "مجلس النواب", "البرلمان", "وزارة الخارجية", "وزير الخارجية", "العلاقات الثنائية",
    "علاقات ثنائية", "الشراكة الاستراتيجية", "شراكة استراتيجية", "اتفاقية", "اتفاقيات", "مذكرة تفاهم", "مذكرات تفاهم", "زيارة رسمية", "مباحثات",
    "مفاوضات", "وفد حكومي", "اللجنة المشتركة", "لجنة مشتركة", "المجلس الأعلى للتعاون", "تعاون مشترك", "تنسيق مشترك", "بيان مشترك", "دبلوماسي",
    "دبلوماسية", "سياسة خارجية", "정부", "총리", "대통령", "의회", "외교", "양국 관계", "정상회담", "전략적 파트너십", "협정", "협약", "양해각서", "공동위원회", "공식 방문", "회담",
]
ROUTER_ECONOMY = [
    "اقتصاد", "اقتصادي", "اقتصادية", "تجارة", "تجاري", "التبادل التجاري", "استثمار", "استثمارات", "نفط", "غاز", "طاقة", "كهرباء", "مياه", "موارد مائية",
    "نقل", "مواصلات", "طريق التنمية", "سكك حديد", "ميناء", "موانئ", "جمارك", "منطقة حرة", "تمويل", "مصرف", "مصارف", "بنك", "إعمار", "اعمار", "إسكان",
    "اسكان", "بنى تحتية", "بنية تحتية", "مشروع", "مشاريع", "عقد", "عقود", "مقاول", "سوق", "صادرات", "واردات", "زراعة", "صناعة", "اتصالات", "경제", "무역",
    "교역", "투자", "원유", "석유", "가스", "에너지", "전력", "수자원", "교통", "개발도로", "철도", "항만", "관세", "금융", "은행", "재건", "주택", "인프라", "사업", "계약", "수출", "수입", "산업",
]
ROUTER_ECONOMY_HEADLINE = [
    "التبادل التجاري", "التجارة", "الاستثمار", "الاستثمارات", "النفط", "الغاز", "الطاقة", "الكهرباء", "المياه", "النقل", "طريق التنمية", "السكك الحديد",
    "الموانئ", "الجمارك", "التمويل", "الإعمار", "الاسكان", "البنى التحتية", "무역", "교역", "투자", "석유", "가스", "에너지", "전력", "수자원", "교통", "개발도로", "철도", "항만",
    "관세", "금융", "재건", "주택", "인프라",
]
ROUTER_SECURITY = [
    "أمن", "امن", "أمني", "امني", "عسكري", "الجيش", "القوات المسلحة", "الحدود", "أمن الحدود", "امن الحدود", "إرهاب", "ارهاب", "داعش", "هجوم", "تفجير",
    "قصف", "صاروخ", "طائرة مسيرة", "مسيّرة", "مسيّرات", "اغتيال", "اشتباك", "سلاح", "ميليشيا", "اعتقال", "عملية أمنية", "تحالف دولي", "انسحاب القوات",
    "الدفاع", "وزارة الدفاع", "وزارة الداخلية", "안보", "치안", "군사", "국경", "테러", "IS", "공격", "폭발", "공습", "미사일", "드론", "암살", "교전", "무장세력", "체포", "군 철수", "국방",
]
ROUTER_SECURITY_HEADLINE = [
    "أمن الحدود", "امن الحدود", "إرهاب", "ارهاب", "داعش", "هجوم", "تفجير", "قصف", "صاروخ", "طائرة مسيرة", "مسيّرة", "اغتيال", "اشتباك", "انسحاب القوات",
    "التحالف الدولي", "안보", "치안", "국경", "테러", "공격", "폭발", "공습", "미사일", "드론", "암살", "군 철수",
]

# Of the category overrides.
BANKING = [
    "المصارف الاهليه", "المصارف العراقية", "المصارف", "البنوك العراقية", "البنك المركزي العراقي", "الفيدرالي الاميركي", "الاحتياطي الفيدرالي",
    "العقوبات المصرفيه", "رفع العقوبات", "التحويلات الخارجيه", "الامتثال المصرفي", "متطلبات الامتثال", "الدولار", "الحوالات",
]
TURKEY_RELATION = ["العلاقات التركيه العراقيه", "العلاقات العراقيه التركيه", "تركيا والعراق", "العراق وتركيا", "شراكه استراتيجيه"]
COOPERATION = [
    "التجاره", "التبادل التجاري", "الاستثمار", "الاستثمارات", "الطاقه", "النفط", "الغاز", "خط انابيب", "طريق التنميه", "النقل", "المياه", "البنى التحتيه",
    "الاعمار", "المشاريع", "التعاون الاقتصادي", "الشراكه الاقتصاديه", "الربط السككي", "الممر التجاري",
]
OFFICIAL_POSITION = [
    "العراق يدين", "العراق يستنكر", "الحكومه العراقيه تدين", "الحكومه العراقيه تستنكر", "وزاره الخارجيه العراقيه تدين", "وزاره الخارجيه العراقيه تستنكر",
    "رئاسه الجمهوريه تدين", "رئاسه الوزراء تدين", "رئيس الوزراء يدين", "بيان عراقي",
]
ATTACK = ["الضربه", "القصف", "الهجوم", "العدوان", "غاره", "استهداف", "الحشد الشعبي", "القوات العراقيه"]

# Of the validation of fetched reports.
CONTENT_PROJECT = ["bismayah", "bismaya", "bncp"]
CONTENT_COMMISSION = [
    "الهيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "رئيس الهيئة الوطنية للاستثمار", "national investment commission",
    "iraq national investment commission", "عادل الياسري", "عادل داخل الياسري", "حيدر مكية",
]
CONTENT_BUILDER = ["شركة هانوا", "هانوا", "hanwha", "한화"]
CONTENT_HOME = [
    "العراق", "العراقي", "العراقية", "بغداد", "البصرة", "الموصل", "كركوك", "الانبار", "الأنبار", "اربيل", "أربيل", "السليمانية", "كربلاء", "النجف",
    "ديالى", "صلاح الدين", "نينوى", "ذي قار", "ميسان", "واسط", "بابل", "الديوانية", "المثنى", "دهوك", "كردستان العراق", "iraq", "iraqi",
]
CEREMONIAL = ["تهنئة", "تعزية", "برقية تهنئة", "برقية تعزية", "استقبال المهنئين", "ذكرى تأسيس", "حفل تكريم", "زيارة مجاملة"]
POLITICS_ANCHORS = [
    "العراق", "العراقي", "بغداد", "الحكومة العراقية", "مجلس الوزراء", "مجلس النواب", "رئيس مجلس الوزراء", "رئيس الوزراء", "الإطار التنسيقي",
    "اللجنة المالية النيابية", "هيئة النزاهة",
]
POLITICS_SUBSTANCE = [
    "قرار", "قرارات", "توجيه", "توجيهات", "سياسة", "برنامج حكومي", "جلسة", "اجتماع", "تصويت", "قانون", "مشروع قانون", "استجواب", "إقالة", "إعفاء",
    "تعيين", "تشكيل الحكومة", "التشكيلة الوزارية", "الموازنة", "تخصيصات", "تمويل", "مكافحة الفساد", "حصر السلاح", "منح الثقة", "إحالة إلى القضاء",
    "اتفاق", "مذكرة تفاهم", "تنفيذ", "خطة", "إصلاح",
]
ECONOMY_ANCHORS = ["العراق", "العراقي", "بغداد", "وزارة الإعمار", "وزارة المالية", "وزارة التخطيط", "الهيئة الوطنية للاستثمار", "البنك المركزي العراقي", "مجلس الوزراء"]
ECONOMY_SUBSTANCE = [
    "مشروع", "مشاريع", "سكني", "وحدات سكنية", "مدن جديدة", "بنى تحتية", "مقاول", "مقاولين", "مستحقات", "تمويل", "تخصيصات", "الموازنة",
    "الإنفاق الاستثماري", "عقد", "عقود", "استثمار", "مستثمر", "قانون الاستثمار", "إعفاءات جمركية", "مواد البناء", "استئناف", "المشاريع المتلكئة",
    "نسب الإنجاز", "تحويلات خارجية", "امتثال مصرفي", "مصارف",
]
LOW_VALUE = ["أسعار الخضروات", "أسعار الفواكه", "الأسواق المحلية", "مهرجان تسوق", "معرض تجاري صغير", "رواتب المتقاعدين", "البطاقة التموينية"]
CONTENT_FOREIGN = [
    "الهند", "باكستان", "سوريا", "لبنان", "فلسطين", "غزة", "ايران", "إيران", "اليمن", "السعودية", "مصر", "الاردن", "الأردن", "الكويت", "قطر", "الامارات",
    "الإمارات", "البحرين", "تركيا", "افغانستان", "أفغانستان", "كينيا", "الصومال", "المغرب", "تونس", "الجزائر", "السودان", "كولومبيا",
]
SECURITY_ANCHORS = [
    "الحكومة العراقية", "القوات العراقية", "الجيش العراقي", "الشرطة العراقية", "جهاز الامن الوطني", "جهاز الأمن الوطني", "الحشد الشعبي",
    "وزارة الداخلية العراقية", "قيادة العمليات المشتركة",
]
SECURITY_SUBSTANCE = [
    "انفجار", "تفجير", "عبوة ناسفة", "لغم", "هجوم", "هجوم مسلح", "اطلاق نار", "إطلاق نار", "اغتيال", "اشتباك", "قصف", "غارة", "صاروخ", "صواريخ",
    "طائرة مسيرة", "مسيّرات", "داعش", "ارهاب", "إرهاب", "عملية امنية", "عملية أمنية", "اعتقال", "احباط هجوم", "إحباط هجوم", "مقتل", "اصابة", "إصابة",
    "تظاهرة", "تظاهرات", "احتجاج", "احتجاجات", "اعتصام", "قطع الطريق", "اغلاق الطريق", "إغلاق الطريق",
]

# Of importance by rules.
RELIABLE_SOURCES = [
    "وكالة الأنباء العراقية", "واع", "مجلس الوزراء", "مجلس النواب", "رئاسة الوزراء", "البنك المركزي العراقي", "وزارة", "شفق نيوز", "السومرية", "شبكة 964",
    "الجزيرة", "رويترز", "فرانس برس", "أسوشيتد برس", "CNN Arabic", "Kurdistan24",
]
DECISIONS = [
    "قرار", "قرارات", "توجيه", "توجيهات", "تصويت", "قانون", "مرسوم", "اتفاق", "مذكرة تفاهم", "إقرار", "اعتماد", "تنفيذ", "تخصيص", "تمويل", "إقالة",
    "إعفاء", "تعيين", "استقالة",
]
NATIONAL = ["رئيس الوزراء", "مجلس الوزراء", "مجلس النواب", "المحكمة الاتحادية", "رئاسة الجمهورية", "الإطار التنسيقي"]
SENIOR = ["وزير", "رئيس الهيئة الوطنية للاستثمار", "محافظ البنك المركزي", "رئيس مجلس النواب"]
POLICY = ["تشكيل الحكومة", "التشكيلة الوزارية", "الموازنة", "قانون الاستثمار", "عقد حكومي", "مكافحة الفساد", "حصر السلاح", "إقالة", "تعيين"]
POLITICS_BUSINESS = ["الهيئة الوطنية للاستثمار", "مشاريع الإسكان", "العقود الاستثمارية", "الاستثمار الأجنبي", "شركة أجنبية", "بسماية"]
HOUSING = ["مشروع سكني", "مشاريع سكنية", "وحدات سكنية", "مدن جديدة", "مدينة سكنية", "الإسكان", "بسماية"]
INVESTMENT = ["استثمار", "عقد", "عقود", "مستثمر", "قانون الاستثمار", "إعفاءات جمركية", "تمويل", "تحويلات خارجية", "ضمانات"]
NATIONAL_ECONOMY = ["الموازنة", "العجز", "الدين العام", "البنك المركزي", "سعر الصرف", "النفط", "صادرات النفط", "الغاز", "أوبك", "الموانئ", "طريق التنمية"]
FOREIGN_BUSINESS = ["شركة أجنبية", "الاستثمار الأجنبي", "تحويلات خارجية", "الاعتماد المستندي", "الكمارك", "الضرائب", "شركة هانوا"]
ECONOMY_SCALE = ["مليار", "تريليون", "مشروع استراتيجي", "مشروع وطني", "آلاف الوحدات", "اتفاقية دولية"]
TERROR = ["إرهاب", "إرهابي", "داعش", "هجوم إرهابي", "تفجير", "انفجار", "عبوة ناسفة", "انتحاري", "اغتيال", "قصف", "صاروخ", "طائرة مسيرة", "اشتباكات مسلحة", "خلية إرهابية"]
INCIDENT = ["قتل", "مقتل", "إصابة", "جرح", "استهداف", "هاجم", "انفجرت", "اعتقال", "إحباط"]
CAPITAL = ["بسماية", "بغداد", "مطار بغداد", "المدائن", "النهروان", "طريق بغداد"]
COUNTRY = ["العراق", "العراقي", "القوات الأمنية العراقية", "الحشد الشعبي", "جهاز مكافحة الإرهاب"]
SECURITY_SCALE = ["قتلى", "جرحى", "ضحايا", "هجوم واسع", "حالة الطوارئ", "إغلاق الطرق", "تعليق الرحلات"]
FOREIGNERS = ["أجانب", "شركة أجنبية", "سفارة", "بعثة دبلوماسية", "إجلاء", "تحذير أمني"]
COUNTRY_DIRECT = ["العراق", "الحكومة العراقية", "رئيس الوزراء العراقي", "بغداد", "الحدود العراقية", "الأجواء العراقية"]
PRIORITY_COUNTRIES = [
    "الولايات المتحدة", "أمريكا", "إيران", "تركيا", "السعودية", "الكويت", "الأردن", "سوريا", "الإمارات", "كوريا", "الصين", "الأمم المتحدة", "أوبك",
    "صندوق النقد الدولي", "البنك الدولي",
]
IMPACT = ["عقوبات", "اتفاق", "حدود", "مياه", "غاز", "كهرباء", "نفط", "تجارة", "أمن", "قصف", "تأشيرات", "رحلات جوية", "طريق التنمية", "استثمار", "مضيق هرمز", "الملاحة"]
PROJECT_IMPACT = ["بسماية", "شركة هانوا", "الهيئة الوطنية للاستثمار", "الشركات الكورية", "المشاريع السكنية", "الاستثمار الأجنبي"]
OFFICIAL = ["بيان رسمي", "أعلن مكتب رئيس الوزراء", "ذكرت الدائرة الإعلامية"]
SCORE_PROJECT = ["بسماية", "مدينة بسماية الجديدة", "مشروع بسماية"]
SCORE_BUILDER = ["شركة هانوا", "هانوا", "Hanwha"]
SCORE_COMMISSION = ["الهيئة الوطنية للاستثمار", "رئيس الهيئة الوطنية للاستثمار"]
PROJECT_BUSINESS = ["استئناف المشروع", "استكمال المشروع", "العقد", "مستحقات", "دفعات", "تمويل", "ضمان", "تنفيذ", "وحدات سكنية", "تسليم", "صيانة"]
GOVERNMENT = ["رئيس الوزراء", "مجلس الوزراء", "مكتب رئيس الوزراء"]
TURMOIL = ["أزمة", "احتجاجات", "انقسام", "استقالة", "إقالة", "تصويت", "حكومة جديدة", "حل البرلمان", "فساد"]
EXECUTION = ["تنفيذ", "بدء", "افتتاح", "توقيع"]

# Of reports of one event.
STOP_WORDS = [
    "في", "من", "على", "الى", "إلى", "عن", "مع", "بعد", "قبل", "خلال", "هذا", "هذه", "ذلك", "التي", "الذي", "وهو", "وهي", "قال", "أكد", "اعلن", "أعلن",
    "كشف", "اوضح", "أوضح", "العراق", "العراقي", "العراقية", "اليوم", "امس", "أمس", "جديد", "اخبار", "أخبار", "عاجل", "بشأن", "حول", "ضمن", "جراء", "لدى",
    "بين", "العام", "الماضي", "الحالي",
]
ENTITY_ALIASES = {
    "ORG_NIC": ["الهيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "رئاسة الهيئة الوطنية للاستثمار", "هيئة الاستثمار"],
    "PERSON_ADIL_AL_YASIRI": ["عادل داخل الياسري", "عادل الياسري", "عادل داخل"],
    "PERSON_HAIDER_MAKKIYA": ["حيدر مكية", "حيدر مكّية"],
}
ACTION_ALIASES = {
    "PERSONNEL_APPOINTMENT": ["تكليف", "تعيين", "تسمية", "تولي المنصب", "تسلم مهام", "تسيير أعمال"],
    "PERSONNEL_REMOVAL": ["إعفاء", "إقالة", "إنهاء تكليف", "إنهاء مهام", "سحب يد"],
}
BILATERAL_ALIASES = {
    "COUNTRY_EGYPT": ["مصر", "المصري", "المصرية"],
    "COUNTRY_IRAQ": ["العراق", "العراقي", "العراقية"],
    "ORG_NIC": ["الهيئة الوطنية للاستثمار", "هيئة الاستثمار الوطنية", "رئاسة الهيئة الوطنية للاستثمار", "هيئة الاستثمار"],
    "ORG_EGYPT_COMMERCIAL_REP": ["التمثيل التجاري المصري", "مكتب التمثيل التجاري المصري", "التمثيل التجاري في بغداد", "التمثيل التجاري"],
    "TOPIC_INVESTMENT": ["الاستثمار", "الاستثماري", "الاستثمارية", "الاستثمارات", "المستثمر", "المستثمرين", "المستثمرون"],
    "TOPIC_COOPERATION": ["التعاون", "المشترك", "المشتركة", "الشراكة"],
    "EVENT_DISCUSSION": ["مباحثات", "بحث", "يبحث", "تبحث", "تبحثان", "مناقشات", "ناقش", "اجتماع", "لقاء"],
    "ANCHOR_INVESTOR_MOBILITY": ["حركة المستثمرين", "تسهيل حركة المستثمرين", "تيسير حركة المستثمرين"],
    "ANCHOR_BUSINESS_EXCHANGE": ["الزيارات المتبادلة", "مجتمعي الأعمال", "مجتمع الأعمال"],
}
ENTITY_TERMS = [
    "رئيس الوزراء", "مجلس الوزراء", "مجلس النواب", "الاطار التنسيقي", "هيئة النزاهة", "وزارة الاعمار", "وزارة المالية", "وزارة التخطيط",
    "البنك المركزي العراقي", "داعش", "الولايات المتحدة", "ايران", "تركيا", "سوريا", "بغداد", "البصرة", "نينوى", "الانبار", "كركوك", "ديالى", "صلاح الدين",
    "مضيق هرمز", "طريق التنمية", "بسماية", "هانوا", "محمد شياع السوداني", "علي الزيدي", "نوري المالكي",
]
