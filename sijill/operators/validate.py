"""Checks as rows: check_name, passed, doc_slug, record_id, severity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions import values as v
from ..sources.storage import checkpointed

REQUIRED = ("doc_slug", "doc_id", "title_ar", "doc_type", "status", "source_url")


def filled(c: Column) -> Column:
    return F.coalesce(text.strip(c.cast("string")) != "", F.lit(False))


def rows(df: DataFrame, checks: list[tuple[Column | str, Column, str]], record: Column | None = None) -> DataFrame:
    """Each check of each row; checks are (name, passed, severity)."""
    made = F.array(*[F.struct((F.lit(n) if isinstance(n, str) else n).alias("check_name"), F.coalesce(p, F.lit(False)).alias("passed"), F.lit(s).alias("severity")) for n, p, s in checks])
    record = F.lit(None).cast("string") if record is None else record.cast("string")
    return df.select("doc_slug", record.alias("record_id"), F.explode(made).alias("c")).select("doc_slug", "record_id", "c.*")


def present(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """A failure for each wanted doc_slug without a document; the other checks see documents only."""
    return rows(wanted.select("doc_slug").distinct().join(docs.select("doc_slug"), "doc_slug", "left_anti"), [("has_document", F.lit(False), "error")])


def documents(docs: DataFrame) -> DataFrame:
    c = F.col
    checks = [(f"required_field_{f}", filled(c(f)), "error") for f in REQUIRED]
    checks += [("title_contains_arabic", text.contains_arabic(c("title_ar")), "error"), ("status_valid", c("status").isin(*v.VALID_STATUSES), "error"),
               ("source_url_format", c("source_url").startswith("http"), "warning")]
    return rows(docs, checks)


def versions(docs: DataFrame, found: DataFrame) -> DataFrame:
    n = found.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_current").alias("current"))
    whole = docs.select("doc_slug").join(n, "doc_slug", "left").fillna(0, ["n", "current"])
    out = rows(whole, [("has_at_least_one_version", F.col("n") > 0, "error")])
    out = out.unionByName(rows(whole.filter("n > 0"), [("exactly_one_current_version", F.col("current") == 1, "error")]))
    dated = found.filter("is_current and effective_from is not null and effective_to is not null")
    out = out.unionByName(rows(dated, [("version_date_order", F.col("effective_to") > F.col("effective_from"), "warning")], F.col("version_id")))
    return out.unionByName(rows(found, [("version_text_not_empty", filled(F.col("full_text_original")), "error")], F.col("version_id")))


def sections(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Repeated orders, empty texts, parents that aren't there: failures only, besides presence and the number of articles.

    Each check reads the sections, so what they need of them is checkpointed; texts stay behind.
    """
    place = "list_position" if "list_position" in found.columns else "display_order"
    leaking = F.exists(F.array(*[F.lit(a) for a in v.ARTIFACT_LINES]), lambda a: F.contains("original_text", a))
    found = checkpointed(found.select("doc_slug", "version_id", "section_id", "display_order", "section_type", "parent_section_id", F.col(place).alias("place"),
                                      filled(F.col("original_text")).alias("filled"), leaking.alias("leaking")))
    n = found.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("n"))
    whole = docs.select("doc_slug").join(n, "doc_slug", "left").fillna(0, ["n"])
    out = rows(whole, [("has_sections", F.col("n") > 0, "warning")])
    out = out.unionByName(rows(whole.filter("n > 0"), [("article_count_info", F.lit(True), "info")]))
    repeat = F.row_number().over(Window.partitionBy("version_id", "display_order").orderBy("section_id"))
    out = out.unionByName(rows(found.withColumn("k", repeat).filter("k > 1"), [("unique_section_order", F.lit(False), "error")], F.col("section_id")))
    empty = found.filter(~F.col("filled") & ~F.col("section_type").isin("chapter", "part", "title"))
    out = out.unionByName(rows(empty, [("section_text_not_empty", F.lit(False), "warning")], F.col("section_id")))
    there = found.select(F.col("section_id").alias("parent_section_id"), F.col("doc_slug")).distinct()
    orphans = found.filter("parent_section_id is not null").join(there, ["doc_slug", "parent_section_id"], "left_anti")
    out = out.unionByName(rows(orphans, [("section_parent_fk", F.lit(False), "warning")], F.col("section_id")))
    first = found.filter("leaking").groupBy("doc_slug").agg(F.min_by("section_id", "place").alias("section_id"))
    return out.unionByName(rows(first, [("ui_artifact_in_section_text", F.lit(False), "warning")], F.col("section_id")))


def relationships(found: DataFrame, docs: DataFrame) -> DataFrame:
    df = found.withColumn("doc_slug", F.col("source_doc_slug")).join(docs.select("doc_slug", F.col("doc_id").alias("own_id")), "doc_slug", "left")
    wrong = rows(df.filter(~F.col("source_doc_id").eqNullSafe(F.col("own_id"))), [("relationship_source_matches_doc", F.lit(False), "error")], F.col("rel_id"))
    outside = rows(df.filter(~F.coalesce(F.col("confidence").between(0, 1), F.lit(False))), [("relationship_confidence_range", F.lit(False), "warning")], F.col("rel_id"))
    return wrong.unionByName(outside)


def topics(docs: DataFrame, found: DataFrame) -> DataFrame:
    n = found.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_primary").alias("n_primary"))
    whole = docs.select("doc_slug").join(n, "doc_slug", "left").fillna(0, ["n", "n_primary"])
    name = F.when(F.col("n") == 0, "has_topic_assignments").otherwise("exactly_one_primary_topic")
    return rows(whole, [(name, (F.col("n") > 0) & (F.col("n_primary") == 1), "warning")])  # one pass, which works the topics out once


def metadata(docs: DataFrame, body: str = "original_text") -> DataFrame:
    """Fields that are empty though the text suggests otherwise: failures only."""
    undated = docs.filter(filled(F.col("official_gazette_number")) & ~filled(F.col("publication_date")))
    baseless = docs.filter(~filled(F.col("legal_basis_text")) & F.substring(F.col(body), 1, 1500).rlike(v.BASIS_TRIGGERS))
    return (rows(undated, [("missing_publication_date", F.lit(False), "warning")])
            .unionByName(rows(baseless, [("missing_legal_basis_text", F.lit(False), "warning")])))


def files(docs: DataFrame, present: DataFrame, *paths: str) -> DataFrame:
    """Whether the files that documents name are among those present (path)."""
    parts = []
    for p in paths:
        named = docs.filter(filled(F.col(p))).select("doc_slug", F.col(p).alias("path"))
        there = named.join(present.select("path", F.lit(True).alias("there")).distinct(), "path", "left")
        parts.append(rows(there, [(f"file_exists_{p}", F.col("there"), "warning")], F.col("path")))
    return reduce(DataFrame.unionByName, parts)


def verdicts(results: DataFrame) -> DataFrame:
    """doc_slug, validation_passed, n_errors, n_warnings; nothing blocks an export."""
    failed = lambda s: F.count_if(~F.col("passed") & (F.col("severity") == s))
    out = results.groupBy("doc_slug").agg(failed("error").alias("n_errors"), failed("warning").alias("n_warnings"))
    return out.withColumn("validation_passed", F.col("n_errors") == 0)


def quality(docs: DataFrame, sections: DataFrame, entities: DataFrame, topics: DataFrame, exported: DataFrame, expected: int | None = None) -> DataFrame:
    """Checks over a whole data set: check_name, passed, n (offending rows, or for counts the number)."""
    counts = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_slug").alias("slugs"), F.count_if(F.col("doc_type") == "unknown").alias("unknown"),
                      F.count_if((F.col("source_status_text") == "غير ساري") & (F.col("status") == "active")).alias("odd"))
    n = F.col("n")
    per = lambda name, passed, value: F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), value.cast("long").alias("n"))
    base = counts.select(F.explode(F.array(
        per("1a_row_count", n == expected if expected is not None else n > 0, n), per("1b_unique_slugs", n == F.col("slugs"), n - F.col("slugs")),
        per("1c_no_unknown_type", F.col("unknown") == 0, F.col("unknown")), per("5a_status_agrees", F.col("odd") == 0, F.col("odd")))).alias("c")).select("c.*")
    zero = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), (F.col("n") == 0).alias("passed"), "n")
    own = docs.select("doc_slug").distinct()
    both = docs.select("doc_slug", F.col("doc_type").alias("t")).join(exported.select("doc_slug", F.col("doc_type").alias("u"), F.col("section_count").alias("k")), "doc_slug")
    n_sections = sections.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("m"))
    parts = [
        base, zero(own.join(sections, "doc_slug", "left_anti"), "2a_sections_present"), zero(sections.filter(~filled(F.col("original_text"))), "2b_no_empty_section"),
        zero(entities.filter(text.count_words(F.col("entity_name_ar")) > 5), "3a_no_long_entities"), zero(own.join(topics, "doc_slug", "left_anti"), "4a_topic_present"),
        zero(own.join(exported, "doc_slug", "left_anti").select("doc_slug").unionByName(exported.join(own, "doc_slug", "left_anti").select("doc_slug")), "6a_same_slugs"),
        zero(both.filter(~F.col("t").eqNullSafe(F.col("u"))), "6b_same_types"),
        zero(both.join(n_sections, "doc_slug", "left").filter(F.col("k") != F.coalesce("m", F.lit(0))), "6c_same_section_counts"),
    ]
    return reduce(DataFrame.unionByName, parts)
