"""Word lists, maps and patterns that results depend on. Patterns are Java's, with (?U) for Unicode classes."""

# Characters.
TATWEEL = "ـ"
ZERO_WIDTH = "​‌‍﻿­"
ALEF_FROM, ALEF_TO = "آأإٱ", "اااا"
DIGITS_FROM, DIGITS_TO = "٠١٢٣٤٥٦٧٨٩", "0123456789"
HARAKAT = "[ً-ٟ]"
HARAKAT_LETTERS = "".join(map(chr, range(0x64B, 0x660)))
SPACES = " \t\u00a0\u3000"
#: What (?U)\s matches.
WHITE_SPACE = "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ENTITIES = [("&amp;", "&"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#8206;", ""), ("&#8207;", "")]
LINE_END = "[\\n\\r\\u000b\\u000c\\u001c-\\u001e\\u0085\\u2028\\u2029](?:(?<=\\r)\\n)?"

# Lines that page furniture leaves in a text.
ARTIFACT_LINES = [
    "ديوان التشريع والرأي", "ديوان التشريع و الرأي", "التشريعات الأردنية", "ارتباطات المادة", "رقم التشريع",
    "سنة التشريع", "نوع التشريع", "الاسم التفصيلي", "التشريع كما صدر", "التشريعات المرتبطة", "طباعة التشريع",
    "العودة الى الصفحة السابقة", "العودة إلى الصفحة السابقة", "تعديل التشريع", "المعلومات الاساسية", "المعلومات الأساسية",
]

# Document types by the word in a title, by the listing's word, by the type id in an address.
DOC_TYPES = [
    ("دستور", "constitution"), ("قانون", "law"), ("نظام", "regulation"), ("تعليمات", "instructions"), ("قرار", "decision"),
    ("منشور", "circular"), ("تعميم", "circular"), ("اتفاقية", "agreement"), ("معاهدة", "treaty"), ("مرسوم ملكي", "royal_decree"),
    ("مرسوم", "royal_decree"), ("أمر ملكي", "royal_order"), ("إرادة ملكية", "royal_will"), ("إعلان", "declaration"),
]
URL_TYPES = {"1": "law", "2": "regulation", "3": "instructions", "4": "agreement"}
LISTING_TYPES = {
    "دستور": "constitution", "قانون": "law", "نظام": "regulation", "نظام داخلي": "regulation", "تعليمات": "instructions",
    "قرار": "decision", "منشور": "circular", "أمر ملكي": "royal_order", "إرادة ملكية": "royal_will",
    "مرسوم ملكي": "royal_decree", "اتفاقية": "agreement", "معاهدة": "treaty",
}
LISTING_TYPE_IDS = {
    1: "دستور", 2: "قانون", 3: "نظام داخلي", 4: "تعليمات", 5: "قرار", 6: "منشور", 7: "أمر ملكي", 8: "إرادة ملكية",
    9: "مرسوم ملكي", 10: "اتفاقية", 11: "معاهدة",
}
# How pages name the parts of a document, in the order of search; kinds of elements that aren't a document's.
TITLE_CONTAINER = "clicked-legislation-header"
TITLE_CLASSES = [("h3", "animated")]
BODY_CONTAINERS = ["clicked-legislation-content", "main-content", "dir=['\"]rtl['\"]"]
PAGE_FURNITURE = ["script", "style", "nav", "header", "footer", "noscript", "iframe", "button"]

# What listings' links, titles and table rows tell; the type where a link names none.
LISTING_ID = r"LegislationID=(\d+)"
LISTING_TYPE = r"LegislationType=(\d+)"
TITLE_NUMBER = r"(?U)رقم\s*\(?(\d+)\)?"
TITLE_YEAR = r"(?U)لسنة\s*(\d{4})"
ROW_YEAR = r"(?U)\b(19[89]\d|20[012]\d)\b"
DEFAULT_TYPE_ID = 2

# Statuses by the listing's word.
STATUSES = {
    "نافذ": "active", "نافذة": "active", "ساري": "active", "سارية": "active", "ملغى": "repealed", "ملغي": "repealed",
    "ملغية": "repealed", "غير ساري": "repealed", "غير سارية": "repealed", "منتهي": "repealed", "منتهية": "repealed",
    "معدّل": "amended", "معدل": "amended", "معدّلة": "amended", "معدلة": "amended", "موقوف": "suspended",
    "موقوفة": "suspended", "مؤقت": "draft", "مؤقتة": "draft",
}
STATUS_NAMES = {"active": "نافذ", "repealed": "ملغى", "amended": "معدّل"}
VALID_STATUSES = ["active", "amended", "repealed", "draft", "pending", "suspended"]
REFERENCE_TYPES = {"القانون": "law", "قانون": "law", "النظام": "regulation", "نظام": "regulation", "قرار": "decision", "الاتفاقية": "agreement"}
CONSTITUTION = "constitution-hashemite-kingdom-1952"
ATTACHMENT_WORDS = ["ملحق", "جدول", "نموذج", "مرفق"]

# Numbers and ordinals; as the alternatives are tried in order, twelfth to nineteenth match as second to ninth.
ORDINAL = ("(?:الأول[ىا]?|الثانية?|الثالثة?|الرابعة?|الخامسة?|السادسة?|السابعة?|الثامنة?|التاسعة?|العاشرة?|"
           "الحادي عشر|الثاني عشر|الثالث عشر|الرابع عشر|الخامس عشر|السادس عشر|السابع عشر|الثامن عشر|التاسع عشر|العشرون)")
ORDINAL_NUMBERS = {
    "الأول": 1, "الأولى": 1, "الثاني": 2, "الثانية": 2, "الثالث": 3, "الثالثة": 3, "الرابع": 4, "الرابعة": 4,
    "الخامس": 5, "الخامسة": 5, "السادس": 6, "السادسة": 6, "السابع": 7, "السابعة": 7, "الثامن": 8, "الثامنة": 8,
    "التاسع": 9, "التاسعة": 9, "العاشر": 10, "العاشرة": 10, "الحادي عشر": 11, "الثاني عشر": 12, "الثالث عشر": 13,
    "الرابع عشر": 14, "الخامس عشر": 15, "السادس عشر": 16, "السابع عشر": 17, "الثامن عشر": 18, "التاسع عشر": 19, "العشرون": 20,
}
NUMBER = r"(?:\d+|[٠-٩]+)"

# Headings of sections, on a stripped line.
ARTICLE = rf"(?U)^المادة\s*[\(（]?\s*({NUMBER}|{ORDINAL})\s*[\)）]?"
PART = rf"(?U)^(الباب|الجزء)\s+({ORDINAL}|{NUMBER})"
CHAPTER = rf"(?U)^(الفصل|القسم)\s+({ORDINAL}|{NUMBER})"
LETTER = r"(?U)^([أبجدهوزحطيكلمنسعفصقرشت])[\.\-\)]\s+"
ORDINAL_WORDS = ("أولاً", "ثانياً", "ثالثاً", "رابعاً", "خامساً", "سادساً", "سابعاً", "ثامناً", "تاسعاً", "عاشراً")
ORDINAL_PARAGRAPH = r"(?U)^(أولاً|ثانياً|ثالثاً|رابعاً|خامساً|سادساً|سابعاً|ثامناً|تاسعاً|عاشراً)\s*[:]\s*"
ANNEX_WORDS = ("ملحق", "جدول", "نموذج", "مرفق", "الملحق", "الجدول", "النموذج")
ANNEX = r"(?U)^(ملحق|جدول|نموذج|مرفق|الملحق|الجدول|النموذج)\b"
PREAMBLE_LABEL = "ديباجة"
SECTION_CODES = {"preamble": "pre", "part": "prt", "chapter": "cha", "article": "art", "paragraph": "par", "clause": "cla", "annex": "anx", "title": "ttl"}

# References, dates, numbers.
NUMBER_YEAR = rf"(?U)رقم\s*[\(（]?\s*({NUMBER})\s*[\)）]?\s*لسنة\s*({NUMBER}{{4}})"
# A pattern that begins with many words has their first letters before: these are met sooner.
REFERENCE = rf"(?U)(?=[اقن])(القانون|النظام|قرار|الاتفاقية|قانون|نظام)\s+رقم\s*[\(（]?\s*({NUMBER})\s*[\)）]?\s*لسنة\s*({NUMBER}{{4}})"
SECTION_REFERENCE = rf"(?U)(?:المادة|الفقرة|البند)\s*[\(（]?\s*({NUMBER}|{ORDINAL})\s*[\)）]?\s*(?:(من\s+[؀-ۿ]+(?:\s+[؀-ۿ]+){{0,3}}))?"
GAZETTE = r"(?U)الجريدة الرسمية\s*(?:رقم|عدد|,)?\s*[\(（]?\s*(\d+)\s*[\)）]?"
DATE = r"(?U)(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})"
LEGAL_BASIS = (r"(?sdU)(?=[صباعتو])((?:صادر\s+)?بمقتضى|(?:صادر\s+)?بموجب(?=\s+(?:المادة|أحكام|القانون|الدستور))|استناداً?\s+(?:لأحكام|إلى)|"
               r"بناءً?\s+على(?:\s+أحكام)?|عملاً?\s+بأحكام|تطبيقاً?\s+لأحكام|وفقاً?\s+لأحكام|استناداً?\s+إلى\s+أحكام)(.{10,300}?)(?=\n|$)")

# Phrases that tell amendment, repeal, scope and duties.
AMEND = ("(?=[يتجابم])(?:يُعدَّل|تُعدَّل|يُعدَّلُ|تُعدَّلُ|جرى تعديل|يُعدّل|تُعدّل|التعديل|بتعديل|يعدل القانون رقم|معدلاً بالقانون|معدلا بالقانون|تعديل القانون رقم)")
REPEAL = r"(?U)(?=[يتمإ])(?:يُلغى|تُلغى|ملغى|ملغاة|يُلغى\s+القانون|إلغاء|يلغى القانون رقم|يحل محل|يستبدل|إلغاء القانون)"
SCOPE_GENERAL = "يسري على|يطبق على|ينطبق على|تسري أحكامه على"
SCOPE_GOVERNMENT = "جميع الجهات الحكومية|الوزارات والدوائر|الجهات الرسمية|المؤسسات الحكومية"
FLAGS = {
    "contains_obligation": r"(?U)\b(يجب|يلزم|يتعين|يتوجب|يكون ملزماً|على كل|على الجهات|على الوزارة)\b",
    "contains_prohibition": r"(?U)\b(يُحظر|يُمنع|لا يجوز|لا يُسمح|لا يحق|محظور|ممنوع)\b",
    "contains_approval_requirement": "(بعد الحصول على موافقة|يستلزم الحصول على|بموافقة|بإذن من|بعد استئذان)",
    "contains_deadline": "(خلال مدة لا تزيد|خلال|في غضون|موعد لا يتجاوز|يجب أن يتم خلال|مدة أقصاها)",
    "contains_exception": "(استثناءً من|مع مراعاة|باستثناء|على الرغم من|فيما عدا|باستثناء ما)",
    "contains_reporting_requirement": "(يرفع تقريراً|تقديم تقرير|الإفصاح عن|الإبلاغ عن|رفع بيان|تقرير دوري)",
}
#: The letters that each flag's phrases begin with.
FLAG_LETTERS = {name: "".join(sorted({w[0] for w in pattern.removeprefix(r"(?U)\b").removesuffix(r"\b")[1:-1].split("|")})) for name, pattern in FLAGS.items()}
BASIS_TRIGGERS = "بمقتضى|استناداً|بناءً على"

# Institutions. Kinds in the order in which they are looked for, with their first words.
ENTITY_KINDS = [("ministry", "وزارة"), ("authority", "(?:هيئة|سلطة)"), ("council", "مجلس"), ("court", "محكمة"), ("department", "(?:دائرة|مديرية)")]
ENTITY_WORD = "[ء-غف-يً-ٞٮ-ۓ]+"
ENTITY_BAD = [
    "يسمى", "يهدف", "يقوم", "يكون", "ناتج", "نائبا", "نائباً", "نائبًا", "عليها", "عليهم", "عليه", "إذا", "كانت", "كان",
    "اللازمة", "اللازم", "لتنفيذ", "هذا", "ذلك", "بموجب", "المنصوص", "المذكورة", "المذكور", "أحكام", "لأغراض", "حيثما",
    "وردت", "المقررة", "المحددة",
]
ENTITY_STOP = [
    "من", "في", "على", "إلى", "الى", "عن", "مع", "بعد", "قبل", "عند", "حتى", "حتي", "خلال", "لدى", "لدي", "لدن", "منذ",
    "تجاه", "إزاء", "بين", "فوق", "تحت", "أمام", "خلف", "دون", "بدون", "غير", "و", "أو", "او", "ثم", "بل", "لكن", "لكنه",
    "لكنها", "سواء", "التي", "الذي", "اللذين", "اللتين", "الذين", "اللواتي", "ما", "مما", "لما", "بما", "عما", "لم", "لن",
    "لا", "إن", "ان", "إذا", "اذا", "إلا", "الا", "سنتان", "سنة", "سنوات", "شهرا", "شهران", "أشهر", "رئيس", "نائب",
    "المادة", "الفقرة", "البند", "القائم", "الحالي", "التالية", "التالي", "المشار", "المذكور", "المذكورة", "الاول", "الأول",
]
ENTITY_SUFFIXES = ["ها", "هم", "هما", "هن", "كم", "كن", "ني", "نا"]

# Names of institutions that are variants of another.
ENTITY_MERGES = {
    "مجلس ادارة": "مجلس الإدارة", "مجلس إدارة": "مجلس الإدارة", "مجلس الادارة": "مجلس الإدارة", "مجلس الاداره": "مجلس الإدارة",
    "مجلس التاديب": "مجلس التأديب", "دائرة اخرى": "دائرة أخرى", "دائرة الاحوال المدنية والجوازات": "دائرة الأحوال المدنية والجوازات",
    "دائرة الاراضي والمساحة": "دائرة الأراضي والمساحة", "سلطة المصادر الطبيعيه": "سلطة المصادر الطبيعية",
    "مجلس ادارة الفرع": "مجلس إدارة الفرع", "مجلس الاعيان": "مجلس الأعيان", "مجلس الامناء": "مجلس الأمناء", "مجلس امناء": "مجلس الأمناء",
    "مجلس التأديب الاعلى": "مجلس التأديب الأعلى", "مجلس الوزارء": "مجلس الوزراء", "محكمة اخرى": "محكمة أخرى",
    "محكمة استئناف": "محكمة الاستئناف", "محكمة جمارك": "محكمة الجمارك", "محكمة جمارك البدائية": "محكمة الجمارك البدائية",
    "هيئة اهلية": "هيئة أهلية", "هيئة الاوراق المالية": "هيئة الأوراق المالية", "هيئة تدريس": "هيئة التدريس",
    "هيئة التدريس والمحاضرين": "هيئة التدريس والمحاضرون", "هيئة نيابة": "هيئة النيابة",
    "وزارة الاشغال العامة والاسكان": "وزارة الأشغال العامة والإسكان", "وزارة الاوقاف والشؤون والمقدسات": "وزارة الأوقاف والشؤون والمقدسات",
    "مجلس ادرة الشركة المساهمة": "مجلس ادارة الشركة المساهمة",
}

# Topics that a decision of a language model may name.
DECISION_TOPICS = [
    "constitutional-administrative-law", "tax-financial-law", "civil-law", "criminal-law", "commercial-law", "labor-social-insurance",
    "health-law", "education-law", "environmental-law", "transport-law", "energy-law", "investment-law", "land-planning-law",
    "personal-status-law", "international-agreements-law", "digital-assets-law", "banking-financial-services", "agricultural-insurance-law",
]

# Name spaces of identifiers differ in their fourth byte only.
NAMESPACES = {kind: f"6ba7b81{i}9dad11d180b400c04fd430c8" for i, kind in enumerate(["document", "version", "section", "entity", "topic", "relationship", "fetch"])}
