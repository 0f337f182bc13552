"""Landed files in and out: pages, texts, listings, registries, taxonomies, structured documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY = "fetch_id string, doc_slug string, source_url string, fetch_timestamp string, http_status int, page_title string, html_file_path string, text_file_path string, fetch_notes string"
SUMMARY_TEXTS = ("doc_slug doc_id title_ar title_en doc_type doc_number official_gazette_number publication_date effective_date status status_normalized source_status_text "
                 "legal_basis_text primary_topic primary_topic_ar source_url json_path summary_path structured_at").split()
SUMMARY = T.StructType([*(T.StructField(n, T.StringType()) for n in SUMMARY_TEXTS), *(T.StructField(n, T.LongType()) for n in ("issue_year", "entity_count", "section_count", "article_count", "relationship_count")),
                        T.StructField("primary_topic_confidence", T.DoubleType()), T.StructField("has_legal_basis", T.BooleanType())])


def slug_of(path):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def whole_files(spark: SparkSession, path: str, column: str = "html") -> DataFrame:
    """One row a file: doc_slug (the file's name without its ending), file_path and its whole content."""
    df = spark.read.text(path, wholetext=True)
    return df.select(slug_of(F.col("_metadata.file_path")).alias("doc_slug"), F.col("_metadata.file_path").alias("file_path"), F.col("value").alias(column))


def pages(spark: SparkSession, path: str) -> DataFrame:
    return whole_files(spark, path, "html")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Text files: the first line, up to 200 characters, is the title."""
    df = whole_files(spark, path, "text")
    return df.withColumn("title_ar", F.substring(F.trim(F.split_part("text", F.lit("\n"), F.lit(1))), 1, 200))


def listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", "|").option("multiLine", True).schema(REGISTRY).csv(path)


def append_registry(rows: DataFrame, path: str) -> None:
    names = [c.split()[0] for c in REGISTRY.split(", ")]
    rows.select(*names).write.mode("append").option("header", True).option("sep", "|").csv(path)


def structured(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Documents in JSON, with the fields of the schema and no others."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def summaries(spark: SparkSession, path: str) -> DataFrame:
    return structured(spark, path, SUMMARY)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line of JSON a document."""
    df.write.mode(mode).json(path)


def taxonomy(spark: SparkSession, path: str) -> list[dict]:
    """Topics of a YAML file: a list under `topics`, each with plain values and a list keywords_ar; none if the file is missing."""
    try:
        content = spark.read.text(path, wholetext=True).first()
    except Exception as e:  # Spark names a missing path in its error class only
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    return parse_taxonomy(content[0]) if content else []


def parse_taxonomy(text: str) -> list[dict]:
    """Enough of YAML for a taxonomy: maps of plain values and lists of strings, with comments."""
    topics: list[dict] = []
    inside = None
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip() if not raw.lstrip().startswith("#") else ""
        body = line.strip()
        if not body or body == "topics:":
            continue
        if body.startswith("- ") and ":" in body and inside is None or body.startswith("- id:"):
            topics.append({})
            inside, body = None, body[2:].strip()
        if body.startswith("- "):
            if topics and inside:
                topics[-1][inside].append(plain(body[2:]))
            continue
        key, _, value = body.partition(":")
        if not topics:
            continue
        if value.strip():
            topics[-1][key.strip()], inside = plain(value), None
        else:
            topics[-1][key.strip()], inside = [], key.strip()
    return topics


def plain(value: str):
    value = value.strip()
    if value in ("null", "~", ""):
        return None
    if value[:1] in "\"'" and value[-1:] == value[:1]:
        return value[1:-1]
    return int(value) if value.isdigit() else value


def missing(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Of the wanted outputs those without a folder or file there."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.col("path"))
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    there = found.select(F.explode(F.split(F.regexp_replace("path", r"\.[A-Za-z]+$", ""), "/")).alias("name")).distinct()
    return wanted.join(there, "name", "left_anti")
