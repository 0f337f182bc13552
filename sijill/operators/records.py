"""Records of documents over time: latest rows, resumption, upserts, summaries, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metadata, text
from ..functions import values as v


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """For each key the row that is last by the order; map-side first, so frequent keys need no sort."""
    rest = [c for c in df.columns if c not in keys]
    if any(word in f.dataType.simpleString() for f in df.schema for word in ("map<", "variant", "interval")):  # these have no order
        best = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    else:  # what the order and the row share, as long texts, is carried once
        best = F.max(F.struct(*[F.col(c) for c in order], *[c for c in rest if c not in order])).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, *[f"r.{c}" for c in rest])


def latest_fetch(registry: DataFrame) -> DataFrame:
    """Last successful fetch of each document; of equal times the later row (row_number in the registry)."""
    good = registry.filter(F.coalesce(F.col("html_file_path"), F.lit("")) != "")
    return latest(good, ["doc_slug"], "fetch_timestamp", *(["row"] if "row" in registry.columns else []))


def pending(wanted: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """What isn't done yet, or all if forced."""
    return wanted if force else wanted.join(done.select(*keys), keys, "left_anti")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """New rows instead of old ones of the same key; among equals the last by the order. gen is 1 for new."""
    both = old.withColumn("gen", F.lit(0)).unionByName(new.withColumn("gen", F.lit(1)))
    return latest(both, keys, "gen", *order)


def index(summaries: DataFrame) -> DataFrame:
    """In the order of a corpus index: year, none first, then slug."""
    return summaries.orderBy(F.coalesce("issue_year", F.lit(0)), "doc_slug")


def summaries(docs: DataFrame, sections: DataFrame, entities: DataFrame | None, assigned: DataFrame | None, relations: DataFrame | None) -> DataFrame:
    """A record a document with counts of what was found and its primary topic; what isn't given counts as none."""
    counts = sections.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("section_count"), F.count_if(F.col("section_type") == "article").alias("article_count"))
    out = docs.join(counts, "doc_slug", "left")
    for df, name in ((entities, "entity_count"), (relations, "relationship_count")):
        if df is None:
            out = out.withColumn(name, F.lit(0).cast("long"))
        else:
            out = out.join(df.groupBy("doc_slug").agg(F.count(F.lit(1)).alias(name)), "doc_slug", "left")
    if assigned is not None:
        first = assigned.filter("is_primary").select("doc_slug", F.col("topic_id").alias("primary_topic"), F.col("topic_name_ar").alias("primary_topic_ar"), F.col("confidence").alias("primary_topic_confidence"))
        out = out.join(first, "doc_slug", "left")
    basis = F.coalesce(F.col("legal_basis_text") != "", F.lit(False)) if "legal_basis_text" in docs.columns else F.lit(False)
    return (out.fillna(0, ["section_count", "article_count", "entity_count", "relationship_count"]).withColumn("has_legal_basis", basis)
            .withColumn("json_path", F.concat(F.lit("docs/"), "doc_slug", F.lit(".json"))).withColumn("summary_path", F.concat(F.lit("summaries/"), "doc_slug", F.lit("_summary.json"))))


def batch_report(runs: DataFrame, **shares: str) -> DataFrame:
    """Numbers of a batch's runs (success, skipped), and per cent of the successful where a flag holds, 0 if there are none."""
    good = F.col("success") & ~F.col("skipped")
    n = F.count_if(good)
    share = lambda flag: F.coalesce(F.try_divide(F.lit(100.0) * F.count_if(good & F.col(flag)), n), F.lit(0.0))
    return runs.agg(F.count(F.lit(1)).alias("scraped"), F.count_if(~F.col("skipped")).alias("processed"), F.count_if("skipped").alias("skipped"), n.alias("success"),
                    F.count_if(~F.col("success") & ~F.col("skipped")).alias("failed"), *[F.round(share(flag), 1).alias(name) for name, flag in shares.items()])


def quality_report(runs: DataFrame) -> DataFrame:
    """The figures of a batch in one row: its summary, shares of the successful runs, sections on average, and the slugs that failed.

    runs has doc_slug, success, skipped, legal_basis_text, publication_date, topics, entities, relationships, sections, validation_passed.
    """
    c = F.col
    filled = lambda n: F.coalesce(c(n) != "", F.lit(False))
    flags = runs.withColumns({"has_legal_basis_pct": filled("legal_basis_text"), "has_publication_date_pct": filled("publication_date"), "has_topic_assignments_pct": c("topics") > 0,
                              "has_entities_pct": c("entities") > 0, "has_relationships_pct": c("relationships") > 0, "validation_passed_pct": c("validation_passed")})
    names = ["has_legal_basis_pct", "has_publication_date_pct", "has_topic_assignments_pct", "has_entities_pct", "has_relationships_pct", "validation_passed_pct"]
    good, failed = c("success") & ~c("skipped"), ~c("success") & ~c("skipped")
    out = batch_report(flags, **{n: n for n in names})
    more = runs.agg(F.coalesce(F.round(F.avg(F.when(good, c("sections"))), 1), F.lit(0.0)).alias("avg_sections"), F.array_sort(F.collect_list(F.when(failed, c("doc_slug")))).alias("failed_slugs"))
    rate = F.coalesce(F.round(F.try_divide(F.lit(100.0) * c("success"), c("processed")), 1), F.lit(0.0))
    return out.withColumn("success_rate_pct", rate).crossJoin(more)  # one row each


def profile(docs: DataFrame, sections: DataFrame, assigned: DataFrame, relations: DataFrame) -> DataFrame:
    """A data set's distributions and figures: part, value, n, and figure where it isn't a number of rows."""
    parts = [df.groupBy(F.col(name).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "value", "n", F.lit(None).cast("double").alias("figure"))
             for df, name, part in ((docs, "status", "status"), (docs, "doc_type", "type"), (relations, "rel_type", "relation"), (sections, "section_type", "section"))]
    figure = lambda df, part, **values: df.agg(F.array(*[F.struct(F.lit(k).alias("value"), e.cast("double").alias("figure")) for k, e in values.items()]).alias("f")).select(F.explode("f").alias("f")).select(
        F.lit(part).alias("part"), "f.value", F.lit(None).cast("long").alias("n"), "f.figure")
    parts.append(figure(assigned, "confidence", least=F.min("confidence"), most=F.max("confidence"), mean=F.round(F.avg("confidence"), 6), documents=F.count_distinct("doc_slug")))
    parts.append(figure(sections.groupBy("doc_slug").agg(F.count(F.lit(1)).alias("k")), "sections", mean=F.round(F.avg("k"), 6), documents=F.count(F.lit(1))))
    return union_all(parts)


def from_links(links: DataFrame, site: str) -> DataFrame:
    """Listing entries of links (href, title) to documents: the id and type in the address, year and number in the title; links without an id give none."""
    c, kind = F.col, F.col("legislation_type_id")
    found = links.select(F.regexp_extract("href", v.LISTING_ID, 1).alias("legislation_id"), F.coalesce(F.nullif(F.regexp_extract("href", v.LISTING_TYPE, 1), F.lit("")).try_cast("int"), F.lit(v.DEFAULT_TYPE_ID)).alias("legislation_type_id"),
                         F.coalesce("title", F.lit("")).alias("title_ar")).filter("legislation_id != ''")
    found = found.withColumns({"doc_type_ar": metadata.listing_type_word(kind), "doc_number": F.nullif(F.regexp_extract("title_ar", v.TITLE_NUMBER, 1), F.lit("")), "issue_year": F.nullif(F.regexp_extract("title_ar", v.TITLE_YEAR, 1), F.lit("")).try_cast("int")})
    found = found.withColumns({"doc_type_en": metadata.listing_type(c("doc_type_ar")), "source_status_text": F.lit(""), "status_normalized": F.lit("active"),
                               "detail_url": F.concat(F.lit(site), F.lit("?LegislationID="), c("legislation_id"), F.lit("&LegislationType="), kind.cast("string"))})
    return found.withColumn("doc_slug", entry_slug())


def entry_slug():
    return metadata.listing_slug(F.col("doc_type_en"), F.coalesce("issue_year", F.lit(0)), F.coalesce("doc_number", F.lit("")), F.col("legislation_id"))


def enriched(entries: DataFrame, said: str) -> DataFrame:
    """Listing entries whose missing year, status, type and number come from a free text beside them (a column); the slug is made anew. Words are looked for in their tables' order, anywhere in the text."""
    c, t = F.col, F.coalesce(F.col(said), F.lit(""))

    def first(table: dict, value: bool):
        out = F.when(F.lit(False), F.lit(""))
        for word, name in table.items():
            out = out.when(t.contains(word), F.lit(name if value else word))
        return out

    no_status, no_type = c("source_status_text") == "", c("doc_type_ar") == ""
    year = F.nullif(F.regexp_extract(t, v.ROW_YEAR, 1), F.lit("")).try_cast("int")
    out = entries.withColumns({
        "issue_year": F.coalesce(F.when(c("issue_year") != 0, c("issue_year")), year), "doc_number": F.coalesce(F.when(c("doc_number") != "", c("doc_number")), F.nullif(F.regexp_extract(t, v.TITLE_NUMBER, 1), F.lit(""))),
        "status_normalized": F.coalesce(F.when(no_status, first(v.STATUSES, True)), c("status_normalized")), "source_status_text": F.coalesce(F.when(no_status, first(v.STATUSES, False)), c("source_status_text")),
        "doc_type_en": F.coalesce(F.when(no_type, first(v.LISTING_TYPES, True)), c("doc_type_en")), "doc_type_ar": F.coalesce(F.when(no_type, first(v.LISTING_TYPES, False)), c("doc_type_ar"))})
    return out.withColumn("doc_slug", entry_slug())


def active_only(entries: DataFrame) -> DataFrame:
    return entries.filter("status_normalized = 'active'")


def listing(raw: DataFrame) -> DataFrame:
    """Entries of a listing in one form: alternative field names, type and status words, slugs; each id once."""
    has = lambda *names: F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in raw.columns], F.lit(None).cast("string"))
    word, status = has("TypeArName", "doc_type_ar"), has("Status_AR", "StatusAr", "status")
    kind, year, number = metadata.listing_type(F.coalesce(word, F.lit(""))), has("Year", "issue_year").try_cast("int"), has("Number", "doc_number")
    key = has("pmk_ID", "LegislationID", "id")
    return raw.select(key.alias("legislation_id"), has("Type").try_cast("int").alias("legislation_type_id"), text.strip(F.coalesce(has("Name", "title"), F.lit(""))).alias("title_ar"), word.alias("doc_type_ar"),
                      kind.alias("doc_type_en"), number.alias("doc_number"), year.alias("issue_year"), F.coalesce(status, F.lit("")).alias("source_status_text"),
                      metadata.listing_status(F.coalesce(status, F.lit(""))).alias("status_normalized"),
                      metadata.listing_slug(kind, F.coalesce(year, F.lit(0)), F.coalesce(number, F.lit("")), key).alias("doc_slug")).dropDuplicates(["legislation_id"])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
