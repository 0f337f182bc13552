"""Relational and graph projections, and their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the outputs, in their order.
RELATIONAL = {
    "documents": ("doc_id doc_slug title_ar title_en doc_type doc_number issue_year issuing_entity_id issuing_entity_name_ar official_gazette_number "
                  "publication_date effective_date repeal_date status status_normalized source_status_text legal_basis_text applicability_scope "
                  "applicability_sectors applicability_entities source_url fetch_date raw_html_path raw_text_path has_attachment needs_review notes").split(),
    "versions": ("version_id doc_id doc_slug version_number version_type effective_from effective_to is_current amendment_doc_id amendment_doc_slug "
                 "full_text_original full_text_normalized source_url version_notes").split(),
    "sections": ("section_id version_id doc_id doc_slug section_type section_number section_label parent_section_id display_order word_count "
                 "original_text normalized_text").split(),
    "section_compliance_flags": ("section_id doc_slug version_id section_type section_number compliance_relevant contains_obligation contains_prohibition "
                                 "contains_approval_requirement contains_deadline contains_exception contains_reporting_requirement applicability_targets "
                                 "legal_rules_json evidence_hints_json").split(),
    "entities": "entity_id entity_slug entity_name_ar entity_name_en entity_type parent_entity_id notes".split(),
    "topics": "topic_id topic_slug topic_name_ar topic_name_en parent_topic_id topic_level description".split(),
    "document_topics": "assignment_id doc_id topic_id topic_name_ar is_primary confidence extraction_method matched_keywords".split(),
    "document_relationships": ("rel_id source_doc_id source_doc_slug target_doc_id target_doc_slug rel_type source_article_ref target_article_ref "
                               "extracted_text confidence extraction_method notes").split(),
    "document_entities": "role_id doc_id entity_id entity_name_ar role extracted_text extraction_method notes".split(),
}
NODES = {
    "doc": ("doc_id", "Document", "doc_slug title_ar doc_type issue_year status source_url".split()),
    "version": ("version_id", "Version", "version_id doc_slug version_number version_type is_current effective_from effective_to".split()),
    "section": ("section_id", "Section", "section_id doc_slug section_type section_number section_label display_order word_count".split()),
    "entity": ("entity_id", "Entity", "entity_id entity_slug entity_name_ar entity_type".split()),
    "topic": ("topic_id", "Topic", "topic_id topic_slug topic_name_ar topic_level".split()),
}
EDGES = {
    "HAS_VERSION": ("doc", "version", ["is_current"]), "HAS_SECTION": ("version", "section", ["display_order", "section_type"]),
    "ISSUED_BY": ("doc", "entity", []), "HAS_TOPIC": ("doc", "topic", ["is_primary", "confidence"]),
}
RELATIONS = ["AMENDS", "REPEALS", "BASED_ON", "REFERS_TO", "IMPLEMENTS", "SUPERSEDES", "RELATED_TO"]
RELATION_COLUMNS = ["extracted_text", "confidence"]


def project(df: DataFrame, names: list[str]) -> DataFrame:
    """The wanted columns in their order; those that df lacks are null."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def relational(df: DataFrame, table: str) -> DataFrame:
    return project(df, RELATIONAL[table])


def topic_records(assigned: DataFrame, distinct: bool = True) -> DataFrame:
    """Topics of assignments, of level one; each once, or as often as it is assigned."""
    out = assigned.select("topic_id", "topic_slug", "topic_name_ar", F.lit(1).alias("topic_level"))
    return out.dropDuplicates(["topic_id"]) if distinct else out


def nodes(df: DataFrame, kind: str) -> DataFrame:
    key, label, names = NODES[kind]
    whole = project(df, list(dict.fromkeys([key, *names])))
    return whole.select(F.col(key).alias(f":ID({kind})"), *names, F.lit(label).alias(":LABEL"))


def edges(df: DataFrame, kind: str, start: str, end: str) -> DataFrame:
    """Edges of a kind between the two id columns; rows without an end have none."""
    a, b, names = EDGES.get(kind) or ("doc", "doc", RELATION_COLUMNS)
    return df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        F.col(start).alias(f":START_ID({a})"), F.col(end).alias(f":END_ID({b})"), F.lit(kind).alias(":TYPE"), *names)


def relation_edges(found: DataFrame) -> DataFrame:
    """Edges between documents of every kind, with up to 200 characters of text."""
    return found.select(F.col("source_doc_id").alias(":START_ID(doc)"), F.col("target_doc_id").alias(":END_ID(doc)"), F.col("rel_type").alias(":TYPE"),
                        F.substring("extracted_text", 1, 200).alias("extracted_text"), "confidence")


def plain(c: Column, kind: T.DataType) -> Column:
    """A value as text: null as empty, lists and records as JSON."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def serialized(df: DataFrame) -> DataFrame:
    return df.select(*[plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Files with a header and | between values; as many as df has partitions."""
    serialized(df).write.mode(mode).option("sep", "|").option("header", True).option("emptyValue", "").csv(path)


def write_relations(found: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder a kind of relation."""
    out = serialized(relation_edges(found))
    out.withColumn("kind", F.col("`:TYPE`")).write.mode(mode).partitionBy("kind").option("sep", "|").option("header", True).csv(path)


def empty_edges(spark, start: str = "doc", end: str = "doc") -> DataFrame:
    """Edges of a kind that nothing yields yet: a header only."""
    return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in (f":START_ID({start})", f":END_ID({end})", ":TYPE")]))
