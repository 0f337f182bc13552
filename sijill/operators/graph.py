"""Questions about the graph of documents; edges are (source, target, rel_type)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import checkpointed


def active_in_topic(docs: DataFrame, assigned: DataFrame, topic: str) -> DataFrame:
    """Active documents of a topic, by year."""
    hit = assigned.filter(F.col("topic_slug") == topic).select("doc_slug").distinct()
    return docs.filter(F.col("status") == "active").join(hit, "doc_slug", "left_semi").orderBy("issue_year", "doc_slug")


def sources_of(docs: DataFrame, edges: DataFrame, rel_type: str, target: str | None = None) -> DataFrame:
    """Documents with an edge of a kind, to one target or to any."""
    hit = edges.filter(F.col("rel_type") == rel_type)
    if target is not None:
        hit = hit.filter(F.col("target") == target)
    return docs.join(hit.select(F.col("source").alias("doc_slug"), "target"), "doc_slug")


def issued_by(docs: DataFrame, roles: DataFrame, name: str) -> DataFrame:
    hit = roles.filter((F.col("role") == "issuer") & (F.col("entity_name_ar") == name)).select("doc_slug").distinct()
    return docs.join(hit, "doc_slug", "left_semi")


def repeal_chains(edges: DataFrame, rel_type: str = "REPEALS") -> DataFrame:
    """start, terminal, hops: every path along edges of a kind from where one begins to where none goes on, of any length; a path ends before it would meet itself, but may begin with an edge to its own start. Edges without both ends are left out.

    Paths are doubled: of `exact` all have 2^k hops, of `ended` all have fewer and lead to a terminal, so n hops take log n rounds.
    """
    def extended(paths, more):
        more = more.select(F.col("start").alias("end"), F.col("end").alias("to"), F.col("path").alias("rest"))
        rest = F.expr("slice(rest, 2, size(rest))")
        return paths.join(more, "end").filter(~F.arrays_overlap("path", rest)).select("start", F.col("to").alias("end"), F.concat("path", rest).alias("path"))

    own = checkpointed(edges.filter((F.col("rel_type") == rel_type) & F.col("source").isNotNull() & F.col("target").isNotNull()).select("source", "target").distinct())
    last = own.select(F.col("target").alias("start")).distinct().join(own.select(F.col("source").alias("start")), "start", "left_anti")
    ended = last.select("start", F.col("start").alias("end"), F.array("start").alias("path"))
    exact = own.filter("source != target").select(F.col("source").alias("start"), F.col("target").alias("end"), F.array("source", "target").alias("path"))
    while not exact.isEmpty():
        ended = checkpointed(ended.unionByName(extended(exact, ended)))
        exact = checkpointed(extended(exact, exact))
    found = ended.select("start", F.col("end").alias("terminal"), (F.size("path") - 1).alias("hops")).filter("hops > 0")
    looped = own.filter("source = target").select(F.col("source").alias("start"))
    return found.unionByName(found.join(looped, "start", "left_semi").withColumn("hops", F.col("hops") + 1))


def section_tree(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """Sections of documents with their parents' labels, in order."""
    parent = sections.select(F.col("section_id").alias("parent_section_id"), F.col("section_label").alias("parent_label"), "doc_slug")
    own = sections.join(docs.select("doc_slug").distinct(), "doc_slug", "left_semi")
    return own.join(parent, ["doc_slug", "parent_section_id"], "left").select("doc_slug", "display_order", "section_type", "section_label", "parent_label")


def disconnected(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """Documents without any edge."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("doc_slug"))  # in one pass over the edges
    return docs.join(ends, "doc_slug", "left_anti")
