"""Inputs in Arabic, made from the tables by SQL that several engines read alike, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, metadata, text
from ..operators import extract, segment, topics

LATIN, LETTERS = "abcdefghijklmnopqrstuvwxyz", "أبتثجحخدذرزسشصىطظعإفقكلمنة"
#: Documents' whole texts in Arabic letters.
ARABIC = f"translate(lower(coalesce(text, '')), '{LATIN}', '{LETTERS}')"
#: A text for cleaning: tags, entities, stretched and vocalised words, page marks, odd spaces and digits.
NOISY = f"""
SELECT doc_id, concat('<p class="x">', {ARABIC}, '</p> &amp;lt; &nbsp;قَانُون ممـــتد', '\u200b', ' رقم (',
  translate(CAST(doc_id AS STRING), '0123456789', '٠١٢٣٤٥٦٧٨٩'), ')', chr(10), '- ', CAST(doc_id % 90 AS STRING), ' -', chr(10), chr(10), chr(10), chr(10),
  'Page 3 of 9 صفحة 7\u00a0نهاية  المدرسة', chr(10), 'ارتباطات المادة', chr(10), 'المادة الاولى مدرسة ') AS raw FROM documents"""
#: A statute for each document; its article holds the document's whole text. It refers to the one before it.
STATUTES = f"""
SELECT doc_id, concat('law-', CAST(1950 + doc_id % 75 AS STRING), '-', CAST(doc_id + 1 AS STRING)) AS doc_slug,
  concat(CASE doc_id % 7 WHEN 0 THEN 'قانون' WHEN 1 THEN 'نظام' WHEN 2 THEN 'تعليمات' WHEN 3 THEN 'قانــون' WHEN 4 THEN 'القانون الاساسي' WHEN 5 THEN 'مرسوم ملكي' ELSE 'وثيقة' END, ' ',
    CASE doc_id % 5 WHEN 0 THEN 'الصحة العامة' WHEN 1 THEN 'ضريبة الدخل' WHEN 2 THEN 'العمل والعمال' WHEN 3 THEN 'البيئة' ELSE 'النقل البري' END,
    ' رقم (', CAST(doc_id + 1 AS STRING), ') لسنة ', CAST(1950 + doc_id % 75 AS STRING)) AS title_ar,
  concat('https://example.org/doc?LegislationType=', CAST(doc_id % 5 + 1 AS STRING), '&id=', CAST(doc_id AS STRING)) AS source_url,
  concat('نحن الموقعون ادناه نصادق على ما يلي', chr(10),
    CASE WHEN doc_id % 3 = 0 THEN 'بمقتضى المادة (31) من الدستور' WHEN doc_id % 3 = 1 THEN concat('استناداً إلى أحكام قانون رقم (', CAST(doc_id AS STRING), ') لسنة ', CAST(1950 + (doc_id + 74) % 75 AS STRING), ' نصدر هذا')
         WHEN doc_id % 2 = 0 THEN 'جدول المحتويات' ELSE 'تمهيد عام' END, chr(10),
    CASE WHEN doc_id % 2 = 0 THEN 'الباب الأول' ELSE '' END, chr(10), CASE WHEN doc_id % 4 < 2 THEN 'الفصل الثاني' ELSE '' END, chr(10), 'المادة (1)', chr(10),
    'تتولى وزارة ', CASE doc_id % 4 WHEN 0 THEN 'العدل' WHEN 1 THEN 'المالية والتخطيط' WHEN 2 THEN 'الصحة' ELSE 'التربية والتعليم' END,
    ' بالتنسيق مع مجلس الوزراء تنفيذ احكام هذا القانون ويجب التقيد خلال شهر', chr(10), 'أ- لا يجوز مخالفة احكام هذه المادة دون علم دائرة ضريبة الدخل', chr(10), 'ب- يعمل بما يأتي', chr(10),
    {ARABIC}, chr(10), 'المادة ٢', chr(10),
    CASE doc_id % 5 WHEN 0 THEN concat('يلغى القانون رقم (', CAST(doc_id AS STRING), ') لسنة ', CAST(1950 + (doc_id + 74) % 75 AS STRING))
      WHEN 1 THEN concat('تعديل القانون رقم (', CAST(doc_id AS STRING), ') لسنة ', CAST(1950 + (doc_id + 74) % 75 AS STRING)) ELSE 'وفق نظام رقم (12) لسنة 2001 والمادة (5) من هذا القانون' END, chr(10),
    'أولاً: يعمل به من 15/04/2001 و 30-12-', CAST(1990 + doc_id % 30 AS STRING), chr(10), 'نشر في الجريدة الرسمية رقم ', CAST(1000 + doc_id % 500 AS STRING), chr(10),
    CASE WHEN doc_id % 7 = 0 THEN 'ملحق رقم 1' ELSE 'انتهى' END) AS text
FROM documents"""
#: A small taxonomy; real ones are loaded by sources.files.taxonomy.
TAXONOMY = [
    {"id": "health-law", "name_ar": "قانون الصحة", "keywords_ar": ["الصحة العامة", "الصحة", "المستشفيات"]},
    {"id": "tax-financial-law", "name_ar": "القانون المالي", "keywords_ar": ["ضريبة الدخل", "المالية", "ضريبة"]},
    {"id": "labor-social-insurance", "name_ar": "قانون العمل", "keywords_ar": ["العمل والعمال", "العمال"]},
    {"id": "environmental-law", "name_ar": "قانون البيئة", "keywords_ar": ["البيئة", "الطبيعة"]},
    {"id": "education-law", "name_ar": "قانون التعليم", "keywords_ar": ["التربية والتعليم", "المدارس", "التعليم", "التربية"]},
    {"id": "transport-law", "name_ar": "قانون النقل", "keywords_ar": ["النقل البري", "النقل"]},
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def made(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM documents", "FROM {docs}"), docs=table(spark, sf_dir, "documents"))


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, NOISY)


def statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, STATUTES)


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.sections(statutes(spark, sf_dir), "doc_slug")


def documents(df: DataFrame, *more: str, original: str = "text") -> DataFrame:
    """Document records of statutes: metadata of the title and the opening of the text; more columns are carried along."""
    opening = F.concat_ws("\n", "title_ar", F.substring("text", 1, metadata.OPENING))
    d = metadata.dates(opening)
    return df.select("doc_slug", ids.doc_id(F.col("doc_slug")).alias("doc_id"), "title_ar", metadata.doc_type(F.col("title_ar")).alias("doc_type"),
                     metadata.doc_number(opening).alias("doc_number"), metadata.issue_year(opening).alias("issue_year"), metadata.gazette_number(opening).alias("official_gazette_number"),
                     metadata.publication_date(d).alias("publication_date"), metadata.effective_date(d).alias("effective_date"), metadata.status(opening).alias("status"),
                     F.get(metadata.legal_basis(opening), F.lit(0)).alias("legal_basis_text"), "source_url", F.col(original).alias("original_text"), *more)


def versions(df: DataFrame) -> DataFrame:
    """The first version of each document."""
    return df.select(ids.version_id(F.col("doc_slug")).alias("version_id"), "doc_id", "doc_slug", F.lit(1).alias("version_number"), F.lit("original").alias("version_type"),
                     F.coalesce(F.nullif("effective_date", F.lit("")), "publication_date").alias("effective_from"), F.lit(None).cast("string").alias("effective_to"),
                     F.lit(True).alias("is_current"), F.col("original_text").alias("full_text_original"), text.for_search(F.col("original_text")).alias("full_text_normalized"), "source_url")


def topic_scores(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return topics.scores(df.withColumn("normalized_text", text.normalize(F.col("text"))), TAXONOMY, key, normal=True)


def links(df: DataFrame) -> DataFrame:
    """(source, target, rel_type) of statutes' relationships."""
    found = extract.relationships(df)
    return found.select(F.col("source_doc_slug").alias("source"), F.col("target_doc_slug").alias("target"), "rel_type")
