"""From landed pages to all tables, for a whole corpus at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, metadata, text
from ..operators import extract, records, segment, topics, validate
from ..sources.storage import checkpointed
from . import corpus


def parsed(pages: DataFrame) -> DataFrame:
    """doc_slug, source_url, title_ar, text of pages (doc_slug, html, source_url); texts may be given instead of html."""
    if "html" not in pages.columns:
        return pages.select("doc_slug", "source_url", "title_ar", "text")
    html = F.col("html")
    return pages.select("doc_slug", "source_url", metadata.html_title(html).alias("title_ar"), text.remove_artifact_lines(metadata.html_body(html)).alias("text"))


def newest(pages: DataFrame) -> DataFrame:
    """One page a doc_slug: the last by fetch_timestamp, if there is one, else by its content."""
    order = [c for c in ("fetch_timestamp", "html", "text", "source_url") if c in pages.columns]
    return records.latest(pages, ["doc_slug"], *order)


class Tables(Mapping):
    """Tables by name, each planned when it is first asked for, once."""

    def __init__(self, plans: dict[str, Callable[["Tables"], DataFrame]], public: list[str]) -> None:
        self.plans, self.public, self.made = plans, public, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.plans[name](self)
        return self.made[name]

    def __contains__(self, name: object) -> bool:
        return name in self.public

    def __iter__(self) -> Iterator[str]:
        return iter(self.public)

    def __len__(self) -> int:
        return len(self.public)


def structure(pages: DataFrame, taxonomy: list[dict]) -> Mapping[str, DataFrame]:
    """All tables of a corpus: documents, versions, sections, entities, roles, topics, relationships, validation, summaries.

    Pages are parsed and cleaned, and sections built, once: both are checkpointed when a table first needs
    them, and the tables, which are lazy, derived from them. Of pages of one doc_slug the newest counts.
    """
    def roles(t: Tables) -> DataFrame:
        # institutions come from the text for reading: the copy for search has lost the letters that they are told by
        out = extract.entities(t["cleaned"], "doc_slug", "original_text").withColumn("doc_id", ids.doc_id(F.col("doc_slug")))
        out = out.withColumn("entity_id", ids.entity_id(ids.entity_slug(F.col("entity_name_ar"), F.col("entity_type"))))
        return out.withColumn("role_id", ids.role_id(F.col("doc_id"), F.col("entity_id"), F.col("role")))

    def documents(t: Tables) -> DataFrame:
        issuer = t["document_entities"].filter("role = 'issuer'").select("doc_slug", F.col("entity_id").alias("issuing_entity_id"), F.col("entity_name_ar").alias("issuing_entity_name_ar"))
        status = F.col("status")
        return (corpus.documents(t["cleaned"], "normalized_text", original="original_text").join(issuer, "doc_slug", "left")
                .withColumns({"status_normalized": status, "source_status_text": metadata.status_name(status), "applicability_scope": extract.scope(F.col("normalized_text"))}))

    def checks(t: Tables) -> DataFrame:
        docs, relations = t["documents"], t["document_relationships"]
        return records.union_all([validate.present(newest(pages), docs), validate.documents(docs), validate.versions(docs, t["versions"]), validate.sections(docs, t["sections"]),
                                  validate.topics(docs, t["document_topics"]), validate.relationships(relations, docs), validate.metadata(docs)])

    def summaries(t: Tables) -> DataFrame:
        return records.summaries(t["documents"].drop("original_text", "normalized_text"), t["sections"], t["document_entities"], t["document_topics"],
                                 t["document_relationships"].withColumnRenamed("source_doc_slug", "doc_slug"))

    plans = {
        "documents": documents, "versions": lambda t: corpus.versions(t["documents"]), "sections": lambda t: checkpointed(segment.build(segment.sections(t["cleaned"], "doc_slug"))),
        "entities": lambda t: extract.entity_records(t["document_entities"]), "document_entities": roles,
        "document_topics": lambda t: topics.assignments(topics.ranked(topics.scores(t["cleaned"], taxonomy, "doc_slug"), "doc_slug")),
        "document_relationships": lambda t: extract.relationships(t["cleaned"].withColumn("text", F.col("original_text"))), "validation_results": checks, "summaries": summaries,
        "cleaning_log": lambda t: t["cleaned"].select("doc_slug", text.log_line(F.col("cleaning_log"), F.col("warnings")).alias("l")).select("doc_slug", "l.*"),
    }
    cleaned = lambda t: checkpointed(text.clean(parsed(newest(pages)).filter(F.coalesce(F.col("text"), F.lit("")) != "")))
    return Tables(plans | {"cleaned": cleaned}, list(plans))
