"""Every query of the library and the SQL that says the same, written from what the operator means."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ids, metadata, text
from ..functions import values as v
from ..operators import export, extract, graph, records, segment, topics, validate
from . import corpus
from .corpus import NOISY, STATUTES, TAXONOMY, noisy, statutes, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return put


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# cleaning

def nested(c: str, pairs) -> str:
    for a, b in pairs:
        c = f"replace({c}, '{a}', '{b}')"
    return c


NEWLINES = "chr(10) || chr(10)"
RULE_SQL = {
    "strip_html": lambda c: nested(f"regexp_replace({c}, '<[^>]+>', ' ', 'g')", v.ENTITIES),
    "remove_zero_width": lambda c: f"translate({c}, '{v.ZERO_WIDTH}', '')",
    "remove_tatweel": lambda c: f"replace({c}, 'ـ', '')",
    "remove_harakat": lambda c: f"regexp_replace({c}, '[\\x{{064B}}-\\x{{065F}}]', '', 'g')",
    "remove_page_markers": lambda c: ("regexp_replace(regexp_replace(regexp_replace(" + c + r", '(^|[^\p{L}\p{N}_])صفحة\s+\d+', '\1', 'g'), '(?i)\bPage\s+\d+\s+of\s+\d+\b', '', 'g'), '(?m)^\s*[-–]\s*\d+\s*[-–]\s*$', '', 'g')"),
    "normalize_spaces": lambda c: rf"regexp_replace(regexp_replace(regexp_replace({c}, '[ \t\x{{00a0}}\x{{3000}}]+', ' ', 'g'), '\n{{3,}}', {NEWLINES}, 'g'), '^\s+|\s+$', '', 'g')",
    "western_digits": lambda c: f"translate({c}, '٠١٢٣٤٥٦٧٨٩', '0123456789')",
    "normalize_alef": lambda c: f"translate({c}, 'آأإٱ', 'اااا')",
    "normalize_tamarbouta": lambda c: rf"regexp_replace({c}, 'ة([^\p{{L}}\p{{N}}_]|$)', 'ه\1', 'g')",
    "normalize_yeh": lambda c: f"replace({c}, 'ى', 'ي')",
}


def cleaned_sql(c: str, rules) -> str:
    for r in rules:
        c = RULE_SQL[r](c)
    return c


def add_rule(name: str) -> None:
    def run(spark, sf_dir):
        return noisy(spark, sf_dir).select("doc_id", text.rule(name)(F.col("raw")).alias("cleaned"))
    run.__name__ = "c_" + name
    query(f"WITH noisy AS ({NOISY}) SELECT doc_id, {RULE_SQL[name]('raw')} AS cleaned FROM noisy")(run)


for _name in (*text.DISPLAY_RULES, *text.SEARCH_RULES):
    add_rule(_name)


def normal_sql(c: str) -> str:
    return cleaned_sql(c, [*text.DISPLAY_RULES, *text.SEARCH_RULES])


@query(f"WITH noisy AS ({NOISY}) SELECT doc_id, {normal_sql('raw')} AS cleaned FROM noisy")
def c_normalize_search(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", text.normalize(F.col("raw")).alias("cleaned"))


@query(f"""WITH noisy AS ({NOISY}), lines AS (SELECT doc_id, unnest(string_split(raw, chr(10))) AS line, generate_subscripts(string_split(raw, chr(10)), 1) AS i FROM noisy)
SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS cleaned FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) NOT IN ({', '.join(f"'{a}'" for a in v.ARTIFACT_LINES)}) GROUP BY doc_id""")
def c_artifact_lines(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", text.remove_artifact_lines(F.col("raw")).alias("cleaned"))


@query(rf"""WITH noisy AS ({NOISY}) SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(raw, '[\s\x{{00a0}}]+'), lambda w: w <> '')) AS INTEGER) AS words,
regexp_matches(raw, '[\x{{0600}}-\x{{06FF}}]') AS arabic FROM noisy""")
def c_word_count(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", text.count_words(F.col("raw")).alias("words"), text.contains_arabic(F.col("raw")).alias("arabic"))


def stage_sql() -> str:
    stages, c = [], "raw"
    names = [*text.DISPLAY_RULES, *text.SEARCH_RULES]
    for i, r in enumerate(names):
        stages.append(f"s{i} AS (SELECT *, {RULE_SQL[r](c)} AS t{i} FROM {f's{i - 1}' if i else 'noisy'})")
        c = f"t{i}"
    rows = " UNION ALL ".join(f"SELECT doc_id, '{r}' AS rule, CAST(length({f't{i - 1}' if i else 'raw'}) AS INTEGER) AS chars_before, CAST(length(t{i}) AS INTEGER) AS chars_after FROM s{len(names) - 1}" for i, r in enumerate(names))
    return f"WITH noisy AS ({NOISY}), {', '.join(stages)} {rows}"


@query(stage_sql())
def c_clean_log(spark, sf_dir):
    df = text.clean(noisy(spark, sf_dir), "raw")
    return text.log_entries(df, "doc_id").select("doc_id", "rule", "chars_before", "chars_after")


@query(f"""WITH noisy AS ({NOISY}), d AS (SELECT doc_id, {cleaned_sql('raw', text.DISPLAY_RULES)} AS t FROM noisy)
SELECT doc_id, concat_ws('; ', CASE WHEN NOT regexp_matches(t, '[\\x{{0600}}-\\x{{06FF}}]') THEN 'CRITICAL: no Arabic' END, CASE WHEN length(t) < 200 THEN 'WARN: short text' END,
CASE WHEN NOT contains(t, 'المادة') THEN 'WARN: no article' END) AS warnings FROM d""")
def c_sanity(spark, sf_dir):
    df = text.clean(noisy(spark, sf_dir), "raw")
    return df.select("doc_id", F.array_join("warnings", "; ").alias("warnings"))


# metadata

OPENING_SQL = "title_ar || chr(10) || substr(text, 1, 1500)"


def type_sql(t: str) -> str:
    order = sorted(v.DOC_TYPES, key=lambda x: -len(x[0]))
    whens = [f"WHEN starts_with({t}, '{w}') THEN '{k}'" for w, k in order] + [f"WHEN regexp_matches({t}, '(^|\\s|ال){w}(\\s|$)') THEN '{k}'" for w, k in order]
    return "CASE " + " ".join(whens)


@query(f"""WITH statutes AS ({STATUTES}), t AS (SELECT doc_id, source_url, replace(trim(title_ar), 'ـ', '') AS t FROM statutes)
SELECT doc_id, {type_sql('t')} ELSE 'unknown' END AS doc_type,
{type_sql('t')} ELSE CASE regexp_extract(source_url, 'LegislationType=(\\d+)', 1) WHEN '1' THEN 'law' WHEN '2' THEN 'regulation' WHEN '3' THEN 'instructions' WHEN '4' THEN 'agreement' ELSE 'unknown' END END AS doc_type_by_url FROM t""")
def m_doc_type(spark, sf_dir):
    c = F.col("title_ar")
    return statutes(spark, sf_dir).select("doc_id", metadata.doc_type(c).alias("doc_type"), metadata.doc_type(c, F.col("source_url")).alias("doc_type_by_url"))


@query(f"""WITH statutes AS ({STATUTES}) SELECT doc_id, regexp_extract(title_ar, 'رقم\\s*[(]?\\s*(\\d+)\\s*[)]?\\s*لسنة\\s*(\\d+)', 1) AS doc_number,
CAST(regexp_extract(title_ar, 'رقم\\s*[(]?\\s*(\\d+)\\s*[)]?\\s*لسنة\\s*(\\d+)', 2) AS INTEGER) AS issue_year FROM statutes""")
def m_number_year(spark, sf_dir):
    return statutes(spark, sf_dir).select("doc_id", metadata.doc_number(F.col("title_ar")).alias("doc_number"), metadata.issue_year(F.col("title_ar")).alias("issue_year"))


@query(f"WITH statutes AS ({STATUTES}) SELECT doc_id, regexp_extract(text, 'الجريدة الرسمية\\s*(?:رقم|عدد|,)?\\s*[(]?\\s*(\\d+)', 1) AS gazette FROM statutes")
def m_gazette(spark, sf_dir):
    return statutes(spark, sf_dir).select("doc_id", metadata.gazette_number(F.col("text")).alias("gazette"))


@query(f"""WITH statutes AS ({STATUTES}), m AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{4}}')) AS d, generate_subscripts(regexp_extract_all(text, '\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{4}}'), 1) AS i FROM statutes),
p AS (SELECT doc_id, i, CAST(regexp_extract(d, '^(\\d+)', 1) AS INTEGER) AS a, CAST(regexp_extract(d, '[/-](\\d+)[/-]', 1) AS INTEGER) AS b, CAST(right(d, 4) AS INTEGER) AS y FROM m),
o AS (SELECT doc_id, i, y, CASE WHEN b > 12 AND a <= 12 THEN a ELSE b END AS mo, CASE WHEN b > 12 AND a <= 12 THEN b ELSE a END AS da FROM p),
s AS (SELECT doc_id, min(i) AS i, printf('%04d-%02d-%02d', y, mo, da) AS iso FROM o WHERE y BETWEEN 1900 AND 2099 AND mo BETWEEN 1 AND 12 AND da BETWEEN 1 AND 31 GROUP BY doc_id, iso),
l AS (SELECT doc_id, list(iso ORDER BY i) AS l FROM s GROUP BY doc_id)
SELECT doc_id, array_to_string(l, ',') AS dates, l[1] AS publication_date, coalesce(l[2], l[1]) AS effective_date FROM l""")
def m_dates(spark, sf_dir):
    d = metadata.dates(F.col("text"))
    return statutes(spark, sf_dir).select("doc_id", F.array_join(d, ",").alias("dates"), metadata.publication_date(d).alias("publication_date"), metadata.effective_date(d).alias("effective_date"))


@query(f"""WITH statutes AS ({STATUTES}), s AS (SELECT doc_id, CASE WHEN contains(text, 'يلغى القانون رقم') THEN 'repealed' WHEN contains(text, 'تعديل القانون رقم') THEN 'amended' ELSE 'active' END AS status FROM statutes)
SELECT doc_id, status, CASE status WHEN 'active' THEN 'نافذ' WHEN 'repealed' THEN 'ملغى' ELSE 'معدّل' END AS status_text FROM s""")
def m_status(spark, sf_dir):
    s = metadata.status(F.col("text"))
    return statutes(spark, sf_dir).select("doc_id", s.alias("status"), metadata.status_name(s).alias("status_text"))


STATUS_LIST = list(v.STATUSES)


@query(f"""WITH l AS (SELECT doc_id, list_value({', '.join(f"'{s}'" for s in [*STATUS_LIST, 'مجهول'])})[doc_id % {len(STATUS_LIST) + 1} + 1] AS s,
list_value({', '.join(f"'{s}'" for s in [*v.LISTING_TYPES, 'وثيقة'])})[doc_id % {len(v.LISTING_TYPES) + 1} + 1] AS t FROM documents)
SELECT doc_id, CASE {' '.join(f"WHEN s = '{a}' THEN '{b}'" for a, b in v.STATUSES.items())} ELSE 'active' END AS status, CASE {' '.join(f"WHEN t = '{a}' THEN '{b}'" for a, b in v.LISTING_TYPES.items())} ELSE 'law' END AS doc_type FROM l""")
def m_listing(spark, sf_dir):
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("doc_id") % len(xs) + 1).cast("int"))
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", metadata.listing_status(pick([*STATUS_LIST, "مجهول"])).alias("status"), metadata.listing_type(pick([*v.LISTING_TYPES, "وثيقة"])).alias("doc_type"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'legislation-' || doc_id ELSE 'royal-decree-' || (1950 + doc_id % 75) || '-' || doc_id END AS slug FROM documents""")
def m_slug(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id")
    number = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("doc_id").cast("string"))
    return df.select("doc_id", metadata.listing_slug(F.lit("royal_decree"), 1950 + F.col("doc_id") % 75, number, F.col("doc_id")).alias("slug"))


PAGE_SQL = "html"
for _t in ("script", "style", "nav", "header", "footer", "noscript", "iframe", "button"):
    PAGE_SQL = f"regexp_replace({PAGE_SQL}, '(?is)<{_t}\\b.*?</{_t}\\s*>', '', 'g')"


@query(rf"""WITH p AS (SELECT page_id, {PAGE_SQL} AS h FROM pages), q AS (SELECT page_id,
CASE WHEN regexp_matches(h, '(?is)<h1\b[^>]*>.*?</h1\s*>') THEN regexp_extract(h, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1) WHEN regexp_matches(h, '(?is)<h2\b[^>]*>.*?</h2\s*>') THEN regexp_extract(h, '(?is)<h2\b[^>]*>(.*?)</h2\s*>', 1) ELSE '' END AS t FROM p)
SELECT page_id, regexp_replace(regexp_replace({nested("regexp_replace(t, '<[^>]+>', ' ', 'g')", v.ENTITIES)}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS title FROM q""")
def m_html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", metadata.html_title(F.col("html")).alias("title"))


@query(rf"""WITH p AS (SELECT page_id, {PAGE_SQL} AS h FROM pages), q AS (SELECT page_id, coalesce(nullif(regexp_extract(h, '(?is)<body\b[^>]*>(.*)</body\s*>', 1), ''), h) AS b FROM p)
SELECT page_id, regexp_replace(regexp_replace({nested("regexp_replace(regexp_replace(b, '(?i)<(br|p|div|li|tr)\\b', chr(10) || '<' || chr(92) || '1', 'g'), '<[^>]+>', chr(10), 'g')", v.ENTITIES)}, '\n{{3,}}', {NEWLINES}, 'g'), '^\s+|\s+$', '', 'g') AS body FROM q""")
def m_html_body(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", metadata.html_body(F.col("html")).alias("body"))


@query(r"""WITH p AS (SELECT page_id, concat(html, '<a href="/f/', CAST(page_id AS VARCHAR), '.PDF"><b>x</b></a><a class="k" href="http://e.org/a">ملحق 1</a><a href="b.html">no</a>') AS h FROM pages),
m AS (SELECT page_id, unnest(regexp_extract_all(h, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 1)) AS href, unnest(regexp_extract_all(h, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 2)) AS l FROM p),
n AS (SELECT page_id, trim(href) AS href, trim(regexp_replace(l, '<[^>]+>', '', 'g')) AS l FROM m)
SELECT page_id, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN 'https://site.org' || href ELSE 'https://site.org/' || href END AS url, CASE WHEN l = '' THEN 'attachment' ELSE l END AS label
FROM n WHERE ends_with(lower(href), '.pdf') OR regexp_matches(l, 'ملحق|جدول|نموذج|مرفق')""")
def m_attachments(spark, sf_dir):
    page = F.concat("html", F.lit('<a href="/f/'), F.col("page_id").cast("string"), F.lit('.PDF"><b>x</b></a><a class="k" href="http://e.org/a">ملحق 1</a><a href="b.html">no</a>'))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(metadata.attachments(page, F.lit("https://site.org"))).alias("a")).select("page_id", "a.*")


# sections

LINES_SQL = f"""statutes AS ({STATUTES}),
raw_lines AS (SELECT doc_slug, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM statutes),
lines AS (SELECT doc_slug, pos, regexp_replace(raw, '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g') AS line FROM raw_lines),
kinds AS (SELECT *, CASE WHEN line = '' THEN 'b' WHEN regexp_matches(line, '^(الباب|الجزء)\\s+({v.ORDINAL}|\\d+)') THEN 'P' WHEN regexp_matches(line, '^(الفصل|القسم)\\s+({v.ORDINAL}|\\d+)') THEN 'C'
  WHEN regexp_matches(line, '^المادة\\s*[(]?\\s*(\\d+|[٠-٩]+|{v.ORDINAL})') THEN 'A' WHEN regexp_matches(line, '^(ملحق|جدول|نموذج|مرفق|الملحق|الجدول|النموذج)([^\\p{{L}}\\p{{N}}_]|$)') THEN 'X'
  WHEN regexp_matches(line, '^[أبجدهوزحطيكلمنسعفصقرشت][.)-]\\s') OR regexp_matches(line, '^(أولاً|ثانياً|ثالثاً|رابعاً|خامساً|سادساً|سابعاً|ثامناً|تاسعاً|عاشراً)\\s*:') THEN 'r' ELSE 't' END AS kind FROM lines)"""
SECTIONS_SQL = LINES_SQL + """,
a1 AS (SELECT *, last_value(CASE WHEN kind IN ('P','C','A','X') THEN kind END IGNORE NULLS) OVER (PARTITION BY doc_slug ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lh, min(CASE WHEN kind IN ('P','C','A') THEN pos END) OVER (PARTITION BY doc_slug) AS fm FROM kinds),
a2 AS (SELECT *, kind IN ('P','C','A','X') OR (kind = 'r' AND coalesce(lh, '') = 'A') AS mark FROM a1),
a3 AS (SELECT *, (pos < coalesce(fm, 1000000000)) AND NOT mark AND kind <> 'b' AS pre FROM a2),
a4 AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY doc_slug ORDER BY pos) AS seq, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY doc_slug) AS n,
  bool_or(pre) OVER (PARTITION BY doc_slug) AND fm IS NOT NULL AND NOT bool_or(kind = 'X' AND pos < coalesce(fm, 0)) OVER (PARTITION BY doc_slug) AS head FROM a3),
a5 AS (SELECT *, CASE WHEN pre THEN CASE WHEN head THEN 0 ELSE n + 1 END ELSE seq + CASE WHEN head THEN 1 ELSE 0 END END AS ord FROM a4),
a6 AS (SELECT *, max(CASE WHEN kind = 'P' THEN ord END) OVER w AS lp, max(CASE WHEN kind = 'C' THEN ord END) OVER w AS lc, max(CASE WHEN kind = 'A' THEN ord END) OVER w AS la FROM a5 WINDOW w AS (PARTITION BY doc_slug ORDER BY pos)),
a7 AS (SELECT * FROM a6 WHERE pre OR seq > 0),
sections AS (SELECT doc_slug, CAST(ord AS INTEGER) AS display_order, CASE WHEN pre THEN 'preamble' ELSE max(CASE WHEN mark THEN CASE kind WHEN 'P' THEN 'part' WHEN 'C' THEN 'chapter' WHEN 'A' THEN 'article' WHEN 'X' THEN 'annex' ELSE 'paragraph' END END) END AS section_type,
  CAST(max(CASE WHEN mark THEN CASE kind WHEN 'C' THEN lp WHEN 'A' THEN CASE WHEN lp IS NULL OR lc > lp THEN coalesce(lc, lp) ELSE lp END WHEN 'r' THEN la END END) AS INTEGER) AS parent_order,
  CASE WHEN pre THEN 'ديباجة' ELSE max(CASE WHEN mark THEN line END) END AS section_label,
  regexp_replace(string_agg(line, chr(10) ORDER BY pos), '^\\s+|\\s+$', '', 'g') AS raw_text FROM a7 GROUP BY doc_slug, ord, pre)"""


@query(f"WITH {LINES_SQL} SELECT doc_slug, kind, count(*) AS n FROM kinds GROUP BY doc_slug, kind")
def g_lines(spark, sf_dir):
    return segment.lines(statutes(spark, sf_dir), "doc_slug").groupBy("doc_slug", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SECTIONS_SQL} SELECT doc_slug, display_order, section_type, parent_order, section_label, raw_text FROM sections")
def g_sections(spark, sf_dir):
    return corpus.sections(spark, sf_dir).select("doc_slug", "display_order", "section_type", "parent_order", "section_label", "raw_text")


@query(f"""WITH {SECTIONS_SQL}, ids AS (SELECT *, doc_slug || '-v1-' || CASE section_type WHEN 'preamble' THEN 'pre' WHEN 'part' THEN 'prt' WHEN 'chapter' THEN 'cha' WHEN 'article' THEN 'art' WHEN 'paragraph' THEN 'par' ELSE 'anx' END || '-' || printf('%04d', display_order) AS section_id FROM sections)
SELECT c.section_id, p.section_id AS parent_section_id FROM ids c LEFT JOIN ids p ON p.doc_slug = c.doc_slug AND p.display_order = c.parent_order AND c.parent_order > 0""")
def g_parents(spark, sf_dir):
    return segment.build(corpus.sections(spark, sf_dir)).select("section_id", "parent_section_id")


@query(f"WITH {SECTIONS_SQL} SELECT section_type, count(*) AS n, count(DISTINCT doc_slug) AS docs, max(display_order) AS highest FROM sections GROUP BY section_type")
def g_section_stats(spark, sf_dir):
    return corpus.sections(spark, sf_dir).groupBy("section_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_slug").alias("docs"), F.max("display_order").alias("highest"))


FLAG_TEXT = cleaned_sql("raw_text", [r for r in (*text.DISPLAY_RULES, *text.SEARCH_RULES) if r != "remove_page_markers"])


@query(f"""WITH {SECTIONS_SQL}, f AS (SELECT doc_slug, display_order, {FLAG_TEXT} AS t FROM sections),
g AS (SELECT doc_slug, display_order, regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_])(يجب|يلزم|يتعين|يتوجب)([^\\p{{L}}\\p{{N}}_]|$)') AS contains_obligation, regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_])(لا يجوز|لا يحق|محظور|ممنوع)([^\\p{{L}}\\p{{N}}_]|$)') AS contains_prohibition,
contains(t, 'خلال') OR contains(t, 'في غضون') OR contains(t, 'موعد لا يتجاوز') AS contains_deadline FROM f)
SELECT *, contains_obligation OR contains_prohibition OR contains_deadline AS compliance_relevant FROM g""")
def k_flags(spark, sf_dir):
    return segment.build(corpus.sections(spark, sf_dir)).select("doc_slug", "display_order", "contains_obligation", "contains_prohibition", "contains_deadline", "compliance_relevant")


# extraction

REF_RE = "(القانون|النظام|قرار|الاتفاقية|قانون|نظام)\\s+رقم\\s*[(]?\\s*(\\d+)\\s*[)]?\\s*لسنة\\s*(\\d+)"
REFS_SQL = f"""statutes AS ({STATUTES}), refs AS (SELECT doc_slug, unnest(regexp_extract_all(text, '{REF_RE}')) AS raw, unnest(regexp_extract_all(text, '{REF_RE}', 1)) AS token, unnest(regexp_extract_all(text, '{REF_RE}', 2)) AS num,
unnest(regexp_extract_all(text, '{REF_RE}', 3)) AS year, generate_subscripts(regexp_extract_all(text, '{REF_RE}'), 1) AS pos FROM statutes),
targets AS (SELECT *, CASE token WHEN 'القانون' THEN 'law' WHEN 'قانون' THEN 'law' WHEN 'النظام' THEN 'regulation' WHEN 'نظام' THEN 'regulation' WHEN 'قرار' THEN 'decision' ELSE 'agreement' END || '-' || year || '-' || num AS target FROM refs)"""


@query(f"WITH {REFS_SQL} SELECT doc_slug, CAST(pos - 1 AS INTEGER) AS pos, token, num AS doc_number, year, raw, target AS target_slug FROM targets")
def x_cross_refs(spark, sf_dir):
    return statutes(spark, sf_dir).select("doc_slug", F.posexplode(extract.references(F.col("text"))).alias("pos", "r")).select("doc_slug", "pos", "r.*")


@query(f"""WITH statutes AS ({STATUTES}) SELECT doc_slug, unnest(regexp_extract_all(text, '(?:بمقتضى|استناداً إلى)[^\\n]{{10,300}}')) AS basis FROM statutes""")
def x_legal_basis(spark, sf_dir):
    return statutes(spark, sf_dir).select("doc_slug", F.explode(metadata.legal_basis(F.col("text"))).alias("basis"))


SECTION_REF = "(المادة|الفقرة|البند)\\s*[(]?\\s*(\\d+|[٠-٩]+|" + v.ORDINAL + ")\\s*[)]?\\s*(من\\s+[\\x{0600}-\\x{06FF}]+(\\s+[\\x{0600}-\\x{06FF}]+){0,3})?"


@query(f"""WITH statutes AS ({STATUTES}), m AS (SELECT doc_slug, unnest(regexp_extract_all(text, '{SECTION_REF}')) AS raw, unnest(regexp_extract_all(text, '{SECTION_REF}', 2)) AS num, unnest(regexp_extract_all(text, '{SECTION_REF}', 3)) AS context FROM statutes)
SELECT DISTINCT doc_slug, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS ref_text, translate(num, '٠١٢٣٤٥٦٧٨٩', '0123456789') AS article_number, CASE WHEN regexp_matches(context, 'هذا القانون|هذا النظام|أعلاه|أدناه') THEN 'same_law' WHEN contains(context, 'الدستور') THEN 'constitution' ELSE 'article_reference' END AS ref_type
FROM m WHERE length(num) <= 5""")
def x_section_refs(spark, sf_dir):
    return statutes(spark, sf_dir).select("doc_slug", F.explode(extract.section_references(F.col("text"))).alias("r")).select("doc_slug", "r.*")


ENTITY_PATTERNS = [("ministry", "وزارة\\s+\\S+(?:\\s+وال\\S+)?"), ("council", "مجلس\\s+ال\\S+"), ("department", "دائرة\\s+\\S+\\s+ال\\S+")]
ENTITIES_SQL = f"""statutes AS ({STATUTES}), caught AS ({' UNION ALL '.join(f"SELECT doc_slug, {i} AS k, '{kind}' AS entity_type, unnest(regexp_extract_all(text, '{p}')) AS entity_name_ar FROM statutes" for i, (kind, p) in enumerate(ENTITY_PATTERNS))}),
once AS (SELECT doc_slug, entity_name_ar, min(k) AS k, min(entity_type) AS entity_type FROM caught GROUP BY doc_slug, entity_name_ar),
named AS (SELECT doc_slug, entity_name_ar, entity_type, CASE WHEN k = min(k) OVER (PARTITION BY doc_slug) THEN 'issuer' ELSE 'mentioned' END AS role FROM once)"""


@query(f"WITH {ENTITIES_SQL} SELECT doc_slug, entity_name_ar, entity_type, role FROM named")
def e_entities(spark, sf_dir):
    return extract.entities(statutes(spark, sf_dir), "doc_slug").select("doc_slug", "entity_name_ar", "entity_type", "role")


@query(f"WITH {ENTITIES_SQL}, s AS (SELECT DISTINCT entity_name_ar, entity_type, entity_type || '-' || substr(sha1(encode(entity_name_ar)), 1, 12) AS entity_slug FROM named) SELECT 'entity-' || entity_slug AS entity_id, entity_slug, entity_name_ar, entity_type FROM s")
def e_registry(spark, sf_dir):
    return extract.entity_records(extract.entities(statutes(spark, sf_dir), "doc_slug"))


MERGE_LIST = list(v.ENTITY_MERGES) + ["وزارة العدل"]


@query(f"""WITH n AS (SELECT doc_id, list_value({', '.join(f"'{m}'" for m in MERGE_LIST)})[doc_id % {len(MERGE_LIST)} + 1] AS name FROM documents)
SELECT doc_id, CASE {' '.join(f"WHEN name = '{a}' THEN '{b}'" for a, b in v.ENTITY_MERGES.items())} ELSE name END AS entity_name_ar FROM n""")
def e_merge(spark, sf_dir):
    pick = F.element_at(F.array(*[F.lit(x) for x in MERGE_LIST]), (F.col("doc_id") % len(MERGE_LIST) + 1).cast("int"))
    found = table(spark, sf_dir, "documents").select("doc_id", pick.alias("entity_name_ar"), F.lit("x").alias("entity_type"), F.lit(0).alias("place"), F.lit("issuer").alias("role"))
    return extract.merged(found).select("doc_id", "entity_name_ar")


RELATIONS_SQL = REFS_SQL + """, tally AS (SELECT doc_slug, count(*) AS n FROM refs GROUP BY doc_slug),
based AS (SELECT s.doc_slug, 'law-' || (1950 + (doc_id + 74) % 75) || '-' || doc_id AS target, 'BASED_ON' AS rel_type, 0.85 AS confidence FROM statutes s WHERE doc_id % 3 = 1
  UNION ALL SELECT doc_slug, 'constitution-hashemite-kingdom-1952', 'BASED_ON', 0.9 FROM statutes WHERE doc_id % 3 = 0),
named AS (SELECT t.doc_slug, t.target, CASE WHEN contains(text, 'يلغى القانون رقم') AND n <= 3 THEN 'REPEALS' WHEN contains(text, 'تعديل القانون رقم') AND n <= 5 THEN 'AMENDS' ELSE 'REFERS_TO' END AS rel_type
  FROM targets t JOIN tally USING (doc_slug) JOIN statutes s USING (doc_slug) WHERE t.target <> t.doc_slug),
relations AS (SELECT DISTINCT doc_slug AS source, target, rel_type, CAST(confidence AS DOUBLE) AS confidence FROM based UNION SELECT DISTINCT doc_slug, target, rel_type, CASE rel_type WHEN 'REFERS_TO' THEN 0.6::DOUBLE ELSE 0.8::DOUBLE END FROM named)"""


@query(f"WITH {RELATIONS_SQL} SELECT * FROM relations")
def r_relationships(spark, sf_dir):
    found = extract.relationships(statutes(spark, sf_dir))
    return found.select(F.col("source_doc_slug").alias("source"), F.col("target_doc_slug").alias("target"), "rel_type", "confidence")


@query(f"""WITH statutes AS ({STATUTES}), s AS (SELECT doc_slug, concat(CASE doc_id % 3 WHEN 0 THEN 'على الوزارات والدوائر ' WHEN 1 THEN 'يسري على الكل ' ELSE '' END, substr(text, 1, 100000)) AS t FROM statutes)
SELECT doc_slug, CASE WHEN contains(substr(t, 1, 1000), 'الوزارات والدوائر') THEN 'government_wide' WHEN contains(substr(t, 1, 1000), 'يسري على') THEN 'general' ELSE 'entity_specific' END AS scope FROM s""")
def k_scope(spark, sf_dir):
    head = F.when(F.col("doc_id") % 3 == 0, "على الوزارات والدوائر ").when(F.col("doc_id") % 3 == 1, "يسري على الكل ").otherwise("")
    return statutes(spark, sf_dir).select("doc_slug", extract.scope(F.concat(head, F.col("text"))).alias("scope"))


# topics

KEYWORDS_SQL = "keywords(ord, slug, kw) AS (VALUES " + ", ".join(f"({i}, '{t['id']}', '{k}')" for i, t in enumerate(TAXONOMY) for k in t["keywords_ar"]) + ")"
SCORES_SQL = f"""statutes AS ({STATUTES}), {KEYWORDS_SQL}, plain AS (SELECT ord, slug, kw, {normal_sql('kw')} AS p FROM keywords),
body AS (SELECT doc_id, {normal_sql('title_ar')} AS t, {normal_sql('text')} AS b FROM statutes), cut AS (SELECT doc_id, t, b, {normal_sql('substr(b, 1, 800)')} AS o FROM body),
points AS (SELECT doc_id, ord, slug, sum(CASE WHEN contains(t, p) THEN 40 WHEN contains(o, p) THEN 20 WHEN contains(b, p) THEN 5 ELSE 0 END) AS pts, string_agg(CASE WHEN contains(b, p) THEN kw END, ',' ORDER BY kw) AS matched FROM cut, plain GROUP BY doc_id, ord, slug),
scores AS (SELECT doc_id, ord, slug AS topic_slug, least(100, pts) / 100.0::DOUBLE AS confidence, coalesce(matched, '') AS matched FROM points WHERE pts >= 40),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, ord) AS rank FROM scores)"""


@query(f"WITH {SCORES_SQL} SELECT doc_id, topic_slug, CAST(confidence AS DOUBLE) AS confidence FROM scores")
def t_scores(spark, sf_dir):
    return corpus.topic_scores(statutes(spark, sf_dir)).select("doc_id", "topic_slug", "confidence")


@query(f"WITH {SCORES_SQL} SELECT doc_id, topic_slug, CAST(confidence AS DOUBLE) AS confidence FROM ranked WHERE rank = 1")
def t_primary(spark, sf_dir):
    return topics.primary(corpus.topic_scores(statutes(spark, sf_dir))).select("doc_id", "topic_slug", "confidence")


@query(f"WITH {SCORES_SQL} SELECT doc_id, topic_slug, matched FROM scores")
def t_matched_keywords(spark, sf_dir):
    return corpus.topic_scores(statutes(spark, sf_dir)).select("doc_id", "topic_slug", F.array_join(F.array_sort("matched_keywords"), ",").alias("matched"))


@query(f"WITH {SCORES_SQL} SELECT coalesce(topic_slug, '(none)') AS topic, count(*) AS n FROM statutes LEFT JOIN (SELECT doc_id, topic_slug FROM ranked WHERE rank = 1) USING (doc_id) GROUP BY 1")
def t_distribution(spark, sf_dir):
    df = statutes(spark, sf_dir)
    return topics.distribution(df, corpus.topic_scores(df))


@query(f"""WITH {SCORES_SQL}, model AS (SELECT doc_id, 'model-topic' AS topic_slug, 0.45 + (doc_id % 10) / 100.0 AS confidence FROM documents),
best AS (SELECT doc_id, max(confidence) AS best FROM scores GROUP BY doc_id), better AS (SELECT m.doc_id, m.topic_slug, m.confidence FROM model m LEFT JOIN best USING (doc_id) WHERE coalesce(best, 0) < 0.5 AND m.confidence > coalesce(best, 0))
SELECT doc_id, topic_slug, CAST(confidence AS DOUBLE) AS confidence, true AS is_primary, 'model' AS extraction_method FROM better
UNION ALL SELECT r.doc_id, r.topic_slug, CAST(r.confidence AS DOUBLE), r.rank = 1 AND b.doc_id IS NULL, 'keyword' FROM ranked r LEFT JOIN better b ON b.doc_id = r.doc_id""")
def t_model_fallback(spark, sf_dir):
    df = statutes(spark, sf_dir)
    model = df.select("doc_id", F.lit("model-topic").alias("topic_slug"), F.lit("").alias("topic_name_ar"), ((45 + F.col("doc_id") % 10) / 100).alias("confidence"))
    return topics.with_model(corpus.topic_scores(df), model).select("doc_id", "topic_slug", "confidence", "is_primary", "extraction_method")


@query("""WITH c AS (SELECT label, avg(1) AS one FROM embeddings GROUP BY label), first AS (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label),
l AS (SELECT f.label, e.embedding AS e FROM first f JOIN embeddings e ON e.vec_id = f.vec_id),
s AS (SELECT v.vec_id, l.label, list_cosine_similarity(v.embedding::DOUBLE[], l.e::DOUBLE[]) AS sim FROM embeddings v, l)
SELECT vec_id, arg_max(label, round(sim, 9)) AS label FROM s GROUP BY vec_id""")
def t_embedding_argmax(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    firsts = df.groupBy("label").agg(F.min("vec_id").alias("vec_id")).join(df.drop("label"), "vec_id").select("label", "embedding")
    return topics.nearest_label(df, firsts).select("vec_id", "label")


DECISIONS = """CASE doc_id % 4 WHEN 0 THEN '```json' || chr(10) || '{"topic_id": "topic-civil-law", "confidence": 0.95}' || chr(10) || '```' WHEN 1 THEN 'x {"topic_id": "health-law", "confidence": 0.9} y' WHEN 2 THEN '{"topic_id": "unknown-law", "confidence": 0.99}' ELSE 'no json' END"""


@query(f"""WITH {SCORES_SQL}, best AS (SELECT doc_id, max(confidence) AS best FROM scores GROUP BY doc_id)
SELECT r.doc_id, CASE WHEN rank = 1 AND best < 0.8 AND r.doc_id % 4 = 0 THEN 'civil-law' WHEN rank = 1 AND best < 0.8 AND r.doc_id % 4 = 1 THEN 'health-law' ELSE topic_slug END AS topic_slug,
CAST(CASE WHEN rank = 1 AND best < 0.8 AND r.doc_id % 4 = 0 THEN 0.95 WHEN rank = 1 AND best < 0.8 AND r.doc_id % 4 = 1 THEN 0.9 ELSE confidence END AS DOUBLE) AS confidence,
CASE WHEN rank = 1 AND best < 0.8 AND r.doc_id % 4 < 2 THEN topic_slug END AS original_topic FROM ranked r JOIN best USING (doc_id)""")
def t_enhance_accept(spark, sf_dir):
    df = statutes(spark, sf_dir)
    answer = F.expr(DECISIONS.replace("||", "||"))
    decisions = df.select("doc_id", topics.parsed_decision(answer).alias("d")).filter("d is not null").select("doc_id", "d.*")
    return topics.enhanced(topics.ranked(corpus.topic_scores(df)), decisions).select("doc_id", "topic_slug", "confidence", "original_topic")


# identifiers

def uuid_sql(kind: str, name: str) -> str:
    h = f"sha1(unhex('{v.NAMESPACES[kind]}') || encode({name}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr({h}, 17, 1))::INTEGER % 4 AS INTEGER) + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


@query(f"WITH statutes AS ({STATUTES}) SELECT doc_slug, {uuid_sql('document', 'doc_slug')} AS doc_id, {uuid_sql('topic', chr(39) + 'topic-x' + chr(39) + ' || doc_slug')} AS topic_uuid FROM statutes")
def i_uuid5(spark, sf_dir):
    c = F.col("doc_slug")
    return statutes(spark, sf_dir).select("doc_slug", ids.doc_id(c).alias("doc_id"), ids.uuid5("topic", F.concat(F.lit("topic-x"), c)).alias("topic_uuid"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'law-2001-' || doc_id WHEN 1 THEN 'law-2001-ab-cd' WHEN 2 THEN 'law-2001-some-title' ELSE 'law-2001-unknown' END AS slug FROM documents""")
def i_slug(spark, sf_dir):
    n = F.col("doc_id") % 4
    number = F.when(n == 0, F.concat(F.lit(" "), F.col("doc_id").cast("string"))).when(n == 1, "Ab / cd")
    return table(spark, sf_dir, "documents").select("doc_id", ids.doc_slug(F.lit("LAW"), F.lit(2001), number, F.when(n == 2, "some-title")).alias("slug"))


# summaries, metrics

@query(f"""WITH {SECTIONS_SQL} SELECT doc_slug, count(*) AS section_count, count(*) FILTER (section_type = 'article') AS article_count FROM sections GROUP BY doc_slug""")
def a_summary(spark, sf_dir):
    df = statutes(spark, sf_dir)
    out = records.summaries(corpus.documents(df), segment.sections(df, "doc_slug"), None, None, None)
    return out.select("doc_slug", "section_count", "article_count")


@query("""WITH r AS (SELECT doc_id, doc_id % 9 <> 0 AS success, doc_id % 11 = 0 AS skipped, doc_id % 3 = 0 AS has_date, doc_id % 4 = 0 AS has_basis FROM documents)
SELECT count(*) AS scraped, count(*) FILTER (NOT skipped) AS processed, count(*) FILTER (skipped) AS skipped, count(*) FILTER (success AND NOT skipped) AS success, count(*) FILTER (NOT success AND NOT skipped) AS failed,
round(100.0 * count(*) FILTER (success AND NOT skipped AND has_date) / count(*) FILTER (success AND NOT skipped), 1)::DOUBLE AS date_pct, round(100.0 * count(*) FILTER (success AND NOT skipped AND has_basis) / count(*) FILTER (success AND NOT skipped), 1)::DOUBLE AS basis_pct FROM r""")
def a_batch_quality(spark, sf_dir):
    d = F.col("doc_id")
    runs = table(spark, sf_dir, "documents").select((d % 9 != 0).alias("success"), (d % 11 == 0).alias("skipped"), (d % 3 == 0).alias("has_date"), (d % 4 == 0).alias("has_basis"))
    return records.batch_report(runs, date_pct="has_date", basis_pct="has_basis")


@query(f"""WITH {SCORES_SQL} SELECT count(*) AS rows, count(DISTINCT doc_id) AS docs, CAST(min(confidence) AS DOUBLE) AS least, CAST(max(confidence) AS DOUBLE) AS most, CAST(sum(CAST(round(confidence * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS mean FROM scores""")
def a_profile(spark, sf_dir):
    found = corpus.topic_scores(statutes(spark, sf_dir))
    return found.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("docs"), F.min("confidence").alias("least"), F.max("confidence").alias("most"),
                     (F.sum(F.round(F.col("confidence") * 100).cast("long")).cast("double") / 100 / F.count(F.lit(1))).alias("mean"))


# validation over records that are spoilt by rule

def spoilt(spark, sf_dir):
    """Document records: some titles blank, some statuses illegal, some addresses odd."""
    d = statutes(spark, sf_dir)
    n = F.col("n")
    return d.select("doc_slug", ids.doc_id(F.col("doc_slug")).alias("doc_id"), F.col("doc_id").alias("n"), "title_ar", "source_url").withColumns({
        "title_ar": F.when(n % 17 == 0, " ").otherwise(F.col("title_ar")), "status": F.when(n % 19 == 0, "void").otherwise("active"), "doc_type": F.lit("law"),
        "source_url": F.when(n % 23 == 0, "ftp://x").otherwise(F.col("source_url")), "source_status_text": F.when(n % 29 == 0, "غير ساري").otherwise("نافذ")})


@query(f"""WITH s AS ({STATUTES}), c AS (SELECT doc_slug, unnest(['required_field_doc_slug','required_field_doc_id','required_field_title_ar','required_field_doc_type','required_field_status','required_field_source_url','title_contains_arabic','status_valid','source_url_format']) AS check_name,
unnest([true, true, doc_id % 17 <> 0, true, true, true, doc_id % 17 <> 0, doc_id % 19 <> 0, doc_id % 23 <> 0]) AS passed, unnest(['error','error','error','error','error','error','error','error','warning']) AS severity FROM s) SELECT * FROM c""")
def v_required(spark, sf_dir):
    return validate.documents(spoilt(spark, sf_dir)).select("doc_slug", "check_name", "passed", "severity")


@query(f"""WITH s AS ({STATUTES}), f AS (SELECT doc_slug, CAST(doc_id % 17 = 0 AS INTEGER) * 2 + CAST(doc_id % 19 = 0 AS INTEGER) AS e, CAST(doc_id % 23 = 0 AS INTEGER) AS w FROM s) SELECT doc_slug, CAST(e AS BIGINT) AS n_errors, CAST(w AS BIGINT) AS n_warnings, e = 0 AS validation_passed FROM f""")
def v_tall(spark, sf_dir):
    return validate.verdicts(validate.documents(spoilt(spark, sf_dir)))


@query(f"""WITH s AS ({STATUTES}), n AS (SELECT doc_slug, CASE WHEN doc_id % 13 = 0 THEN 0 WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS k FROM s)
SELECT doc_slug, 'has_at_least_one_version' AS check_name, k > 0 AS passed FROM n UNION ALL SELECT doc_slug, 'exactly_one_current_version', k = 1 FROM n WHERE k > 0
UNION ALL SELECT doc_slug, 'version_text_not_empty', doc_id % 5 <> 0 FROM s JOIN n USING (doc_slug), range(2) t(i) WHERE i < k""")
def v_versions(spark, sf_dir):
    d = statutes(spark, sf_dir)
    n = F.when(F.col("doc_id") % 13 == 0, 0).when(F.col("doc_id") % 7 == 0, 2).otherwise(1)
    found = d.withColumn("i", F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), n))).select(
        "doc_slug", ids.version_id(F.col("doc_slug"), F.col("i")).alias("version_id"), F.lit(True).alias("is_current"), F.lit(None).cast("string").alias("effective_from"),
        F.lit(None).cast("string").alias("effective_to"), F.when(F.col("doc_id") % 5 == 0, "  ").otherwise("x").alias("full_text_original"))
    return validate.versions(d, found).select("doc_slug", "check_name", "passed")


@query(f"""WITH {SECTIONS_SQL}, d AS (SELECT doc_slug, doc_id FROM statutes)
SELECT doc_slug, 'has_sections' AS check_name, true AS passed FROM d UNION ALL SELECT doc_slug, 'article_count_info', true FROM d
UNION ALL SELECT s.doc_slug, 'unique_section_order', false FROM sections s JOIN d USING (doc_slug) WHERE doc_id % 23 = 0 AND display_order = 2
UNION ALL SELECT s.doc_slug, 'section_parent_fk', false FROM sections s JOIN d USING (doc_slug) WHERE doc_id % 29 = 0 AND display_order = 3
UNION ALL SELECT s.doc_slug, 'section_text_not_empty', false FROM sections s JOIN d USING (doc_slug) WHERE doc_id % 31 = 0 AND display_order = 4 AND section_type NOT IN ('part', 'chapter')""")
def v_sections(spark, sf_dir):
    d = statutes(spark, sf_dir)
    built = segment.build(corpus.sections(spark, sf_dir)).join(d.select("doc_slug", F.col("doc_id").alias("n")), "doc_slug")
    order, n = F.col("display_order"), F.col("n")
    spoiled = built.withColumns({"parent_section_id": F.when((n % 29 == 0) & (order == 3), "gone").otherwise(F.col("parent_section_id")), "original_text": F.when((n % 31 == 0) & (order == 4), " ").otherwise(F.replace("original_text", F.lit("تعديل التشريع"), F.lit("")))})
    twice = built.filter((n % 23 == 0) & (order == 2)).withColumn("section_id", F.concat("section_id", F.lit("-b"))).withColumn("parent_section_id", F.lit(None).cast("string")).withColumn("original_text", F.lit("x"))
    return validate.sections(d, spoiled.unionByName(twice)).select("doc_slug", "check_name", "passed")


@query(f"""WITH {SCORES_SQL}, n AS (SELECT s.doc_slug, s.doc_id, count(r.doc_id) AS n FROM statutes s LEFT JOIN ranked r USING (doc_id) GROUP BY ALL)
SELECT doc_slug, CASE WHEN n = 0 THEN 'has_topic_assignments' ELSE 'exactly_one_primary_topic' END AS check_name, n > 0 AND (doc_id % 31 <> 0 OR n = 1) AS passed FROM n""")
def v_topics(spark, sf_dir):
    d = statutes(spark, sf_dir)
    found = topics.ranked(corpus.topic_scores(d)).join(d.select("doc_id", "doc_slug"), "doc_id").withColumn("is_primary", F.col("is_primary") | (F.col("doc_id") % 31 == 0))
    return validate.topics(d, found).select("doc_slug", "check_name", "passed")


@query(f"WITH s AS ({STATUTES}) SELECT count(*) > 0 AS passed, count(*) AS n, '1a_row_count' AS check_name FROM s UNION ALL SELECT true, 0, '1b_unique_slugs' UNION ALL SELECT true, 0, '1c_no_unknown_type' UNION ALL SELECT count(*) FILTER (doc_id % 29 = 0 AND doc_id % 19 <> 0) = 0, count(*) FILTER (doc_id % 29 = 0 AND doc_id % 19 <> 0), '5a_status_agrees' FROM s UNION ALL SELECT true, 0, '2a_sections_present' UNION ALL SELECT true, 0, '2b_no_empty_section' UNION ALL SELECT true, 0, '3a_no_long_entities' UNION ALL SELECT true, 0, '4a_topic_present' UNION ALL SELECT count(*) FILTER (doc_id % 37 = 0) = 0, count(*) FILTER (doc_id % 37 = 0), '6a_same_slugs' FROM s UNION ALL SELECT true, 0, '6b_same_types' UNION ALL SELECT true, 0, '6c_same_section_counts'")
def q_checks(spark, sf_dir):
    docs = spoilt(spark, sf_dir)
    one = docs.select("doc_slug", F.lit("x").alias("original_text"))
    exported = docs.filter("n % 37 != 0").select("doc_slug", "doc_type", F.lit(1).alias("section_count"))
    return validate.quality(docs, one, one.select(F.lit("وزارة العدل").alias("entity_name_ar")), one, exported)


# projections

@query(f"WITH s AS ({STATUTES}) SELECT {uuid_sql('document', 'doc_slug')} AS doc_id, doc_slug, title_ar, source_url FROM s")
def p_documents(spark, sf_dir):
    return export.relational(corpus.documents(statutes(spark, sf_dir)), "documents").select("doc_id", "doc_slug", "title_ar", "source_url")


@query(f"WITH {SCORES_SQL} SELECT DISTINCT 'topic-' || topic_slug AS topic_id, topic_slug FROM scores")
def p_topics_dedup(spark, sf_dir):
    found = topics.ranked(corpus.topic_scores(statutes(spark, sf_dir), "doc_slug"), "doc_slug")
    return export.topic_records(topics.assignments(found)).select("topic_id", "topic_slug")


@query(f"WITH {SECTIONS_SQL} SELECT doc_slug || '-v1' AS start_id, doc_slug || '-v1-' || CASE section_type WHEN 'preamble' THEN 'pre' WHEN 'part' THEN 'prt' WHEN 'chapter' THEN 'cha' WHEN 'article' THEN 'art' WHEN 'paragraph' THEN 'par' ELSE 'anx' END || '-' || printf('%04d', display_order) AS end_id, 'HAS_SECTION' AS kind, section_type FROM sections")
def d_edges(spark, sf_dir):
    e = export.edges(segment.build(corpus.sections(spark, sf_dir)), "HAS_SECTION", "version_id", "section_id")
    return e.select(F.col("`:START_ID(version)`").alias("start_id"), F.col("`:END_ID(section)`").alias("end_id"), F.col("`:TYPE`").alias("kind"), "section_type")


@query(f"WITH {RELATIONS_SQL} SELECT {uuid_sql('document', 'source')} AS start_id, {uuid_sql('document', 'target')} AS end_id, rel_type AS kind FROM relations")
def d_relation_edges(spark, sf_dir):
    e = export.relation_edges(extract.relationships(statutes(spark, sf_dir)))
    return e.select(F.col("`:START_ID(doc)`").alias("start_id"), F.col("`:END_ID(doc)`").alias("end_id"), F.col("`:TYPE`").alias("kind"))


# graph

@query(f"""WITH {SCORES_SQL} SELECT doc_slug, title_ar FROM statutes s JOIN (SELECT DISTINCT doc_id FROM scores WHERE topic_slug = 'health-law') USING (doc_id)
WHERE NOT contains(title_ar || substr(text, 1, 1500), 'يلغى القانون رقم') AND NOT contains(title_ar || substr(text, 1, 1500), 'تعديل القانون رقم')""")
def y_active_in_topic(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return graph.active_in_topic(corpus.documents(d), corpus.topic_scores(d, "doc_slug"), "health-law").select("doc_slug", "title_ar")


def of_kind(kind: str) -> str:
    return f"WITH {RELATIONS_SQL} SELECT source AS doc_slug, target FROM relations WHERE rel_type = '{kind}'"


@query(of_kind("AMENDS"))
def y_amends(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return graph.sources_of(d.select("doc_slug"), corpus.links(d), "AMENDS")


@query(of_kind("BASED_ON") + f" AND target = '{v.CONSTITUTION}'")
def y_based_on(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return graph.sources_of(d.select("doc_slug"), corpus.links(d), "BASED_ON", v.CONSTITUTION)


#: Each order of a customer leads to that customer's next one.
CHAIN = "SELECT * FROM (SELECT CAST(o_orderkey AS VARCHAR) AS source, CAST(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR) AS target FROM orders) WHERE target IS NOT NULL"


@query(f"""WITH RECURSIVE e AS ({CHAIN}), walk AS (SELECT source AS start, target AS cur, [source, target] AS path, 1 AS hops FROM e UNION ALL SELECT w.start, e.target, list_append(w.path, e.target), w.hops + 1 FROM walk w JOIN e ON e.source = w.cur WHERE NOT list_contains(w.path, e.target))
SELECT start, cur AS terminal, hops FROM walk WHERE cur NOT IN (SELECT source FROM e)""")
def y_repeal_chain(spark, sf_dir):
    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("string")
    edges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("source"), following.alias("target"), F.lit("REPEALS").alias("rel_type"))
    return graph.repeal_chains(edges)


@query(f"WITH {ENTITIES_SQL} SELECT doc_slug FROM named WHERE role = 'issuer' AND entity_name_ar = 'وزارة العدل'")
def y_issued_by(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return graph.issued_by(d.select("doc_slug"), extract.entities(d, "doc_slug"), "وزارة العدل")


@query(f"WITH {SECTIONS_SQL} SELECT c.doc_slug, c.display_order, c.section_type, c.section_label, p.section_label AS parent_label FROM sections c LEFT JOIN sections p ON p.doc_slug = c.doc_slug AND p.display_order = c.parent_order AND c.parent_order > 0")
def y_section_tree(spark, sf_dir):
    return graph.section_tree(statutes(spark, sf_dir), segment.build(corpus.sections(spark, sf_dir)))


@query(f"WITH {RELATIONS_SQL} SELECT doc_slug FROM statutes WHERE doc_slug NOT IN (SELECT source FROM relations WHERE rel_type = 'AMENDS') AND doc_slug NOT IN (SELECT target FROM relations WHERE rel_type = 'AMENDS')")
def y_disconnected(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return graph.disconnected(d.select("doc_slug"), corpus.links(d).filter("rel_type = 'AMENDS'"))


# corpus upkeep

@query("""SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def s_latest_fetch(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type <> 'error'")
    return records.latest(e, ["user_id"], "ts", "event_id").select("user_id", "ts", "event_id")


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def s_resume(spark, sf_dir):
    return records.pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id")


@query("""WITH u AS (SELECT o_custkey AS k, o_orderkey AS v, 0 AS gen FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderkey % 2 = 1)
SELECT k, v, gen FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY gen DESC, v DESC) = 1""")
def s_index_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    return records.upserted(o.filter("v % 2 = 0"), o.filter("v % 2 = 1"), ["k"], "v")


# pages with containers, listings

CLASSED = """SELECT page_id, concat('<html><body><nav><h1>قائمة</h1></nav><div class="top clicked-legislation-header"><div><h2>فرعي</h2></div><h3 class="t">قانون ', CAST(page_id AS STRING), ' <b>الصحة</b></h3></div><h1>آخر</h1>',
  '<div class="a clicked-legislation-content b"><div>نص</div><p>', translate(html, '<>&', '   '), '</p><div><div>قانون</div></div></div><div>خارج</div></body></html>') AS html FROM pages"""


def classed(spark, sf_dir):
    return spark.sql(CLASSED.replace("FROM pages", "FROM {docs}"), docs=table(spark, sf_dir, "pages"))


@query(rf"""WITH p AS ({CLASSED}) SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h3 class="t">(.*?)</h3>', 1), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM p""")
def m_classed_title(spark, sf_dir):
    return classed(spark, sf_dir).select("page_id", metadata.html_title(F.col("html")).alias("title"))


@query(rf"""WITH p AS ({CLASSED}), q AS (SELECT page_id, regexp_extract(html, '(?s)clicked-legislation-content b">(.*)</div><div>خارج', 1) AS b FROM p)
SELECT page_id, regexp_replace(regexp_replace({nested("regexp_replace(regexp_replace(b, '(?i)<(br|p|div|li|tr)\\b', chr(10) || '<' || chr(92) || '1', 'g'), '<[^>]+>', chr(10), 'g')", v.ENTITIES)}, '\n{{3,}}', {NEWLINES}, 'g'), '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g') AS body FROM q""")
def m_classed_body(spark, sf_dir):
    return classed(spark, sf_dir).select("page_id", metadata.html_body(F.col("html")).alias("body"))


@query(f"""WITH statutes AS ({STATUTES}) SELECT doc_slug, regexp_extract(title_ar || chr(10) || substr(text, 1, 400), 'وزارة\\s+\\S+(?:\\s+وال\\S+)?') AS issuer, nullif(regexp_extract(title_ar || chr(10) || substr(text, 1, 1500), '(?:بمقتضى|استناداً إلى)[^\\n]{{10,300}}'), '') AS basis FROM statutes""")
def m_issuer_basis(spark, sf_dir):
    opening = F.concat_ws("\n", "title_ar", F.substring("text", 1, metadata.OPENING))
    return statutes(spark, sf_dir).select("doc_slug", extract.issuing_name(F.col("title_ar"), F.col("text")).alias("issuer"), F.get(metadata.legal_basis(opening), F.lit(0)).alias("basis"))


LINKS = """SELECT doc_id, concat('/detail?x=1', CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('&LegislationID=', CAST(doc_id AS STRING)) END, CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('&LegislationType=', CAST(doc_id % 13 AS STRING)) END) AS href,
  concat('قانون ', CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('رقم (', CAST(doc_id + 1 AS STRING), ')') END, CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(' لسنة ', CAST(1950 + doc_id % 75 AS STRING)) END) AS title,
  concat('| ', CASE doc_id % 3 WHEN 0 THEN 'ملغى' WHEN 1 THEN 'موقوف' ELSE '' END, ' | تعليمات | رقم (', CAST(doc_id + 7 AS STRING), ') ', CAST(1970 + doc_id % 60 AS STRING), ' |') AS said FROM documents"""
LINK_SQL = f"""l AS ({LINKS}), m AS (SELECT said, title AS title_ar, regexp_extract(href, 'LegislationID=(\\d+)', 1) AS legislation_id, coalesce(TRY_CAST(nullif(regexp_extract(href, 'LegislationType=(\\d+)', 1), '') AS INTEGER), 2) AS type_id,
  nullif(regexp_extract(title, 'رقم\\s*\\(?(\\d+)', 1), '') AS doc_number, TRY_CAST(nullif(regexp_extract(title, 'لسنة\\s*(\\d{{4}})', 1), '') AS INTEGER) AS issue_year FROM l),
n AS (SELECT *, CASE type_id {' '.join(f"WHEN {i} THEN '{w}'" for i, w in v.LISTING_TYPE_IDS.items())} ELSE '' END AS word FROM m WHERE legislation_id <> ''),
found AS (SELECT *, CASE word {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in v.LISTING_TYPES.items())} ELSE 'law' END AS kind FROM n)"""
SLUG_SQL = "CASE WHEN issue_year IS NOT NULL AND doc_number IS NOT NULL THEN replace(kind, '_', '-') || '-' || issue_year || '-' || doc_number ELSE 'legislation-' || legislation_id END"


def links_of(spark, sf_dir):
    return corpus.made(spark, sf_dir, LINKS)


@query(f"WITH {LINK_SQL} SELECT legislation_id, type_id AS legislation_type_id, word AS doc_type_ar, kind AS doc_type_en, doc_number, issue_year, {SLUG_SQL} AS doc_slug FROM found")
def s_from_links(spark, sf_dir):
    return records.from_links(links_of(spark, sf_dir), "https://site.org/detail").select("legislation_id", "legislation_type_id", "doc_type_ar", "doc_type_en", "doc_number", "issue_year", "doc_slug")


@query(f"""WITH {LINK_SQL}, e AS (SELECT legislation_id, coalesce(doc_number, nullif(regexp_extract(said, 'رقم\\s*\\(?(\\d+)', 1), '')) AS doc_number,
  coalesce(issue_year, TRY_CAST(nullif(regexp_extract(said, '\\b(19[89]\\d|20[012]\\d)\\b', 1), '') AS INTEGER)) AS issue_year, CASE WHEN word = '' THEN 'instructions' ELSE kind END AS kind,
  CASE WHEN contains(said, 'ملغى') THEN 'repealed' WHEN contains(said, 'موقوف') THEN 'suspended' ELSE 'active' END AS status_normalized FROM found)
SELECT legislation_id, doc_number, issue_year, kind AS doc_type_en, status_normalized, {SLUG_SQL} AS doc_slug FROM e""")
def s_enriched(spark, sf_dir):
    df = links_of(spark, sf_dir)
    entries = records.from_links(df, "https://site.org/detail").join(df.select(F.col("doc_id").cast("string").alias("legislation_id"), "said"), "legislation_id")
    return records.enriched(entries, "said").select("legislation_id", "doc_number", "issue_year", "doc_type_en", "status_normalized", "doc_slug")


@query(f"""WITH {LINK_SQL} SELECT legislation_id FROM found WHERE NOT contains(said, 'ملغى') AND NOT contains(said, 'موقوف')""")
def s_active_only(spark, sf_dir):
    df = links_of(spark, sf_dir)
    entries = records.from_links(df, "https://site.org/detail").join(df.select(F.col("doc_id").cast("string").alias("legislation_id"), "said"), "legislation_id")
    return records.active_only(records.enriched(entries, "said")).select("legislation_id")


# validation of presence, dates, relationships, metadata, files

@query(f"WITH s AS ({STATUTES}) SELECT doc_slug, 'has_document' AS check_name, false AS passed FROM s WHERE doc_slug NOT IN (SELECT doc_slug FROM s JOIN labels USING (doc_id))")
def v_present(spark, sf_dir):
    d = statutes(spark, sf_dir)
    return validate.present(d, d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")).select("doc_slug", "check_name", "passed")


@query(f"""WITH s AS ({STATUTES}), d AS (SELECT doc_slug, printf('%04d-01-01', 1950 + doc_id % 75) AS a, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE printf('%04d-01-01', 1990 + doc_id % 7) END AS b FROM s)
SELECT doc_slug, b > a AS passed FROM d WHERE b IS NOT NULL""")
def v_dates(spark, sf_dir):
    d, n = statutes(spark, sf_dir), F.col("doc_id")
    found = d.select("doc_slug", ids.version_id(F.col("doc_slug")).alias("version_id"), F.lit(True).alias("is_current"), F.format_string("%04d-01-01", 1950 + n % 75).alias("effective_from"),
                     F.when(n % 6 != 0, F.format_string("%04d-01-01", 1990 + n % 7)).alias("effective_to"), F.lit("x").alias("full_text_original"))
    return validate.versions(d, found).filter("check_name = 'version_date_order'").select("doc_slug", "passed")


@query(f"""WITH {RELATIONS_SQL}, r AS (SELECT source, target, CASE WHEN ends_with(target, '5') THEN 1.5 ELSE confidence END AS c, CASE WHEN ends_with(target, '7') THEN target ELSE source END AS named FROM relations)
SELECT source AS doc_slug, 'relationship_source_matches_doc' AS check_name FROM r WHERE named <> source UNION ALL SELECT source, 'relationship_confidence_range' FROM r WHERE c NOT BETWEEN 0 AND 1""")
def v_relationships(spark, sf_dir):
    d, t = statutes(spark, sf_dir), F.col("target_doc_slug")
    found = extract.relationships(d).withColumns({"confidence": F.when(t.endswith("5"), 1.5).otherwise(F.col("confidence")), "source_doc_id": F.when(t.endswith("7"), F.col("target_doc_id")).otherwise(F.col("source_doc_id"))})
    return validate.relationships(found, d.select("doc_slug", ids.doc_id(F.col("doc_slug")).alias("doc_id"))).select("doc_slug", "check_name")


@query(f"""WITH s AS ({STATUTES}) SELECT doc_slug, 'missing_publication_date' AS check_name FROM s WHERE regexp_matches(text, 'الجريدة الرسمية\\s*رقم\\s*\\d+') AND doc_id % 4 = 1
UNION ALL SELECT doc_slug, 'missing_legal_basis_text' FROM s WHERE doc_id % 5 = 2 AND regexp_matches(substr(text, 1, 1500), 'بمقتضى|استناداً|بناءً على')""")
def v_metadata(spark, sf_dir):
    d, n = statutes(spark, sf_dir), F.col("doc_id")
    docs = d.select("doc_slug", metadata.gazette_number(F.col("text")).alias("official_gazette_number"), F.when(n % 4 != 1, "2001-01-01").alias("publication_date"), F.when(n % 5 != 2, "x").alias("legal_basis_text"), F.col("text").alias("original_text"))
    return validate.metadata(docs).select("doc_slug", "check_name")


@query(f"""WITH {SECTIONS_SQL}, spoilt AS (SELECT s.doc_slug, display_order, CASE WHEN section_type = 'preamble' THEN 0 ELSE display_order END AS place, raw_text || CASE WHEN doc_id % 9 = 0 AND display_order >= 2 THEN ' طباعة التشريع' ELSE '' END AS t FROM sections s JOIN statutes USING (doc_slug))
SELECT doc_slug, CAST(arg_min(display_order, place) AS INTEGER) AS display_order FROM spoilt WHERE {' OR '.join(f"contains(t, '{a}')" for a in v.ARTIFACT_LINES)} GROUP BY doc_slug""")
def v_artifacts(spark, sf_dir):
    d = statutes(spark, sf_dir)
    built = segment.build(corpus.sections(spark, sf_dir)).join(d.select("doc_slug", F.col("doc_id").alias("n")), "doc_slug")
    spoiled = built.withColumn("original_text", F.when((F.col("n") % 9 == 0) & (F.col("display_order") >= 2), F.concat("original_text", F.lit(" طباعة التشريع"))).otherwise(F.col("original_text")))
    found = validate.sections(d, spoiled).filter("check_name = 'ui_artifact_in_section_text'")
    return found.select("doc_slug", F.regexp_extract("record_id", r"(\d+)$", 1).cast("int").alias("display_order"))


@query(f"WITH s AS ({STATUTES}) SELECT doc_slug, 'file_exists_clean_json_path' AS check_name, doc_id IN (SELECT doc_id FROM labels) AS passed FROM s WHERE doc_id % 4 > 0")
def v_files(spark, sf_dir):
    d = statutes(spark, sf_dir).withColumn("clean_json_path", F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("clean/"), F.col("doc_id").cast("string"))))
    there = table(spark, sf_dir, "labels").select(F.concat(F.lit("clean/"), F.col("doc_id").cast("string")).alias("path"))
    return validate.files(d, there, "clean_json_path").select("doc_slug", "check_name", "passed")


# further projections

SECTION_ID = "doc_slug || '-v1-' || CASE section_type WHEN 'preamble' THEN 'pre' WHEN 'part' THEN 'prt' WHEN 'chapter' THEN 'cha' WHEN 'article' THEN 'art' WHEN 'paragraph' THEN 'par' ELSE 'anx' END || '-' || printf('%04d', display_order)"
DATES_SQL = f"""WITH s AS ({STATUTES}), o AS (SELECT doc_slug, source_url, regexp_extract_all(title_ar || chr(10) || substr(text, 1, 1500), '(\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{4}})') AS d FROM s),
i AS (SELECT doc_slug, source_url, list_distinct(list_transform(d, lambda x: regexp_replace(x, '(\\d+)[/-](\\d+)[/-](\\d+)', '\\3-\\2-\\1'))) AS d, d[1] AS first, d[2] AS second FROM o)"""


@query(f"""{DATES_SQL} SELECT {uuid_sql('document', 'doc_slug')} AS doc_id, doc_slug || '-v1' AS version_id, doc_slug, 1 AS version_number, 'original' AS version_type, true AS is_current, source_url,
regexp_replace(coalesce(second, first), '(\\d+)[/-](\\d+)[/-](\\d+)', '\\3-\\2-\\1') AS effective_from FROM i""")
def p_versions(spark, sf_dir):
    found = export.relational(corpus.versions(corpus.documents(statutes(spark, sf_dir))), "versions")
    return found.select("doc_id", "version_id", "doc_slug", "version_number", "version_type", "is_current", "source_url", "effective_from")


@query(f"WITH {SECTIONS_SQL} SELECT {SECTION_ID} AS section_id, doc_slug || '-v1' AS version_id, section_type, section_label, display_order FROM sections")
def p_sections(spark, sf_dir):
    return export.relational(segment.build(corpus.sections(spark, sf_dir)), "sections").select("section_id", "version_id", "section_type", "section_label", "display_order")


@query(f"""WITH {SECTIONS_SQL}, f AS (SELECT *, {FLAG_TEXT} AS t FROM sections) SELECT {SECTION_ID} AS section_id, regexp_matches(t, 'بعد الحصول على موافقة|يستلزم الحصول على|بموافقة|بإذن من|بعد استئذان') AS contains_approval_requirement,
regexp_matches(t, 'استثناءً من|مع مراعاة|باستثناء|على الرغم من|فيما عدا') AS contains_exception, regexp_matches(t, 'يرفع تقريراً|تقديم تقرير|الإفصاح عن|الإبلاغ عن|رفع بيان|تقرير دوري') AS contains_reporting_requirement FROM f""")
def p_flags(spark, sf_dir):
    found = export.relational(segment.build(corpus.sections(spark, sf_dir)), "section_compliance_flags")
    return found.select("section_id", "contains_approval_requirement", "contains_exception", "contains_reporting_requirement")


@query(f"WITH {SCORES_SQL}, r AS (SELECT doc_slug, topic_slug, rank, confidence FROM ranked JOIN statutes USING (doc_id)) SELECT {uuid_sql('topic', uuid_sql('document', 'doc_slug') + chr(10) + ' || ' + chr(39) + '::topic-' + chr(39) + ' || topic_slug')} AS assignment_id, {uuid_sql('document', 'doc_slug')} AS doc_id, 'topic-' || topic_slug AS topic_id, rank = 1 AS is_primary, CAST(confidence AS DOUBLE) AS confidence FROM r")
def p_document_topics(spark, sf_dir):
    found = topics.ranked(corpus.topic_scores(statutes(spark, sf_dir), "doc_slug"), "doc_slug")
    return export.relational(topics.assignments(found), "document_topics").select("assignment_id", "doc_id", "topic_id", "is_primary", "confidence")


@query(f"WITH {RELATIONS_SQL} SELECT {uuid_sql('relationship', chr(39).join(['source || ', '-', ' || rel_type || ', '-', ' || target']))} AS rel_id, source AS source_doc_slug, target AS target_doc_slug, rel_type, confidence FROM relations")
def p_relationships(spark, sf_dir):
    return export.relational(extract.relationships(statutes(spark, sf_dir)), "document_relationships").select("rel_id", "source_doc_slug", "target_doc_slug", "rel_type", "confidence")


ENTITY_SLUG = "entity_type || '-' || substr(sha1(encode(entity_name_ar)), 1, 12)"
ROLES_SQL = f"""{ENTITIES_SQL}, roles AS (SELECT doc_slug, entity_name_ar, entity_type, role, {uuid_sql('document', 'doc_slug')} AS doc_id, 'entity-' || {ENTITY_SLUG} AS entity_id FROM named)"""


def roles_of(spark, sf_dir):
    return extract.deduplicated(extract.entities(statutes(spark, sf_dir), "doc_slug"))


@query(f"WITH {ROLES_SQL} SELECT {uuid_sql('entity', chr(39).join(['doc_id || ', '::', ' || entity_id || ', '::', ' || role']))} AS role_id, doc_id, entity_id, entity_name_ar, role FROM roles")
def p_document_entities(spark, sf_dir):
    return export.relational(roles_of(spark, sf_dir)["roles"], "document_entities").select("role_id", "doc_id", "entity_id", "entity_name_ar", "role")


@query(f"WITH {ROLES_SQL} SELECT doc_slug, entity_id AS issuing_entity_id, entity_name_ar AS issuing_entity_name_ar FROM roles WHERE role = 'issuer'")
def e_deduplicated(spark, sf_dir):
    return roles_of(spark, sf_dir)["issuers"]


@query(f"WITH n AS (SELECT DISTINCT list_value({', '.join(f"'{m}'" for m in MERGE_LIST)})[doc_id % {len(MERGE_LIST)} + 1] AS name FROM documents), c AS (SELECT name, CASE {' '.join(f"WHEN name = '{a}' THEN '{b}'" for a, b in v.ENTITY_MERGES.items())} ELSE name END AS to_name FROM n) SELECT count(DISTINCT name) AS names_before, count(DISTINCT to_name) AS names_after, count(DISTINCT name) - count(DISTINCT to_name) AS net_reduction FROM c")
def e_merge_counts(spark, sf_dir):
    pick = F.element_at(F.array(*[F.lit(x) for x in MERGE_LIST]), (F.col("doc_id") % len(MERGE_LIST) + 1).cast("int"))
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_slug"), pick.alias("entity_name_ar"), F.lit("x").alias("entity_type"), F.lit(0).alias("place"), F.lit("issuer").alias("role"))
    return extract.deduplicated(found)["counts"]


@query(f"WITH {SECTIONS_SQL} SELECT {SECTION_ID} AS id, section_type, display_order, 'Section' AS label FROM sections")
def n_sections(spark, sf_dir):
    found = export.nodes(segment.build(corpus.sections(spark, sf_dir)), "section")
    return found.select(F.col("`:ID(section)`").alias("id"), "section_type", "display_order", F.col("`:LABEL`").alias("label"))


@query(f"WITH s AS ({STATUTES}) SELECT {uuid_sql('document', 'doc_slug')} AS id, doc_slug, title_ar, source_url, 'Document' AS label FROM s")
def n_documents(spark, sf_dir):
    found = export.nodes(corpus.documents(statutes(spark, sf_dir)), "doc")
    return found.select(F.col("`:ID(doc)`").alias("id"), "doc_slug", "title_ar", "source_url", F.col("`:LABEL`").alias("label"))


@query(f"WITH {ENTITIES_SQL} SELECT DISTINCT 'entity-' || {ENTITY_SLUG} AS id, entity_name_ar, entity_type, 'Entity' AS label FROM named")
def n_entities(spark, sf_dir):
    found = export.nodes(extract.entity_records(extract.entities(statutes(spark, sf_dir), "doc_slug")), "entity")
    return found.select(F.col("`:ID(entity)`").alias("id"), "entity_name_ar", "entity_type", F.col("`:LABEL`").alias("label"))


@query(f"WITH s AS ({STATUTES}) SELECT {uuid_sql('document', 'doc_slug')} AS start_id, doc_slug || '-v1' AS end_id, 'HAS_VERSION' AS kind, true AS is_current FROM s")
def d_has_version(spark, sf_dir):
    e = export.edges(corpus.versions(corpus.documents(statutes(spark, sf_dir))), "HAS_VERSION", "doc_id", "version_id")
    return e.select(F.col("`:START_ID(doc)`").alias("start_id"), F.col("`:END_ID(version)`").alias("end_id"), F.col("`:TYPE`").alias("kind"), "is_current")


@query(f"WITH {ROLES_SQL} SELECT doc_id AS start_id, entity_id AS end_id, 'ISSUED_BY' AS kind FROM roles WHERE role = 'issuer'")
def d_issued_by(spark, sf_dir):
    issuers = roles_of(spark, sf_dir)["issuers"].withColumn("doc_id", ids.doc_id(F.col("doc_slug")))
    e = export.edges(issuers, "ISSUED_BY", "doc_id", "issuing_entity_id")
    return e.select(F.col("`:START_ID(doc)`").alias("start_id"), F.col("`:END_ID(entity)`").alias("end_id"), F.col("`:TYPE`").alias("kind"))


@query(f"WITH {SCORES_SQL}, r AS (SELECT doc_slug, topic_slug, rank, confidence FROM ranked JOIN statutes USING (doc_id)) SELECT {uuid_sql('document', 'doc_slug')} AS start_id, 'topic-' || topic_slug AS end_id, 'HAS_TOPIC' AS kind, rank = 1 AS is_primary, CAST(confidence AS DOUBLE) AS confidence FROM r")
def d_has_topic(spark, sf_dir):
    found = topics.assignments(topics.ranked(corpus.topic_scores(statutes(spark, sf_dir), "doc_slug"), "doc_slug"))
    e = export.edges(found, "HAS_TOPIC", "doc_id", "topic_id")
    return e.select(F.col("`:START_ID(doc)`").alias("start_id"), F.col("`:END_ID(topic)`").alias("end_id"), F.col("`:TYPE`").alias("kind"), "is_primary", "confidence")


# jobs over a stored corpus

@query(f"WITH {SCORES_SQL}, c AS (SELECT doc_id FROM statutes WHERE doc_id IN (SELECT doc_id FROM labels)) SELECT count(*) AS total, count(h.doc_id) AS covered, round(100.0 * count(h.doc_id) / count(*), 1)::DOUBLE AS coverage_pct FROM c LEFT JOIN (SELECT DISTINCT doc_id FROM scores) h USING (doc_id)")
def t_retopic(spark, sf_dir):
    d = statutes(spark, sf_dir)
    clean = d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id").select("doc_slug", text.normalize(F.col("text")).alias("normalized_text"))
    return topics.retopic(d, clean, TAXONOMY)["coverage"]


@query("""WITH r AS (SELECT doc_id, doc_id % 9 <> 0 AS success, doc_id % 11 = 0 AS skipped, doc_id % 4 AS topics, doc_id % 5 AS sections FROM documents), g AS (SELECT * FROM r WHERE success AND NOT skipped)
SELECT (SELECT count(*) FROM r WHERE NOT skipped) AS processed, round(100.0 * count(*) FILTER (topics > 0) / count(*), 1)::DOUBLE AS has_topic_assignments_pct, round(avg(sections), 1)::DOUBLE AS avg_sections,
round(100.0 * count(*) / (SELECT count(*) FROM r WHERE NOT skipped), 1)::DOUBLE AS success_rate_pct, (SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR)) FROM r WHERE NOT skipped AND NOT success) AS failed_slugs FROM g""")
def a_quality_report(spark, sf_dir):
    n = F.col("doc_id")
    runs = table(spark, sf_dir, "documents").select(n.cast("string").alias("doc_slug"), (n % 9 != 0).alias("success"), (n % 11 == 0).alias("skipped"), F.lit("x").alias("legal_basis_text"), F.lit("").alias("publication_date"),
                                                    (n % 4).alias("topics"), F.lit(0).alias("entities"), F.lit(1).alias("relationships"), (n % 5).alias("sections"), F.lit(True).alias("validation_passed"))
    return records.quality_report(runs).select("processed", "has_topic_assignments_pct", "avg_sections", "success_rate_pct", F.array_join("failed_slugs", ",").alias("failed_slugs"))


@query(f"""WITH {SECTIONS_SQL}, {RELATIONS_SQL.removeprefix(f"statutes AS ({STATUTES}), ")} SELECT 'section' AS part, section_type AS value, count(*) AS n FROM sections GROUP BY section_type UNION ALL SELECT 'relation', rel_type, count(*) FROM relations GROUP BY rel_type""")
def a_profile_parts(spark, sf_dir):
    d = statutes(spark, sf_dir)
    docs = corpus.documents(d)
    found = records.profile(docs, corpus.sections(spark, sf_dir), corpus.topic_scores(d, "doc_slug"), extract.relationships(d))
    return found.filter("part in ('section', 'relation')").select("part", "value", "n")


@query(f"WITH {ENTITIES_SQL} SELECT doc_slug, entity_name_ar, entity_type, role FROM named")
def y_structure_entities(spark, sf_dir):
    from .structure import structure

    pages = statutes(spark, sf_dir).select("doc_slug", "source_url", "title_ar", "text")
    return structure(pages, TAXONOMY)["document_entities"].select("doc_slug", "entity_name_ar", "entity_type", "role")
