"""Sections of a text, by windows over its lines.

A line's kind is what its stripped form begins with. A paragraph mark opens a section if the
last heading before it is an article's. Lines before the first part, chapter or article are the
preamble, even after an early annex; other lines belong to the last mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions import values as v


def lines(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, pos, line (stripped), kind: P, C, A, X for headings, r for what may be a paragraph, t for text, b for a blank line."""
    line = F.col("line")
    # a pattern takes time at each letter of a line, so its first words are asked for before
    heads = lambda pattern, *words: text.begins(line, *words) & line.rlike(pattern)
    kind = (F.when(line == "", "b").when(heads(v.PART, "الباب", "الجزء"), "P").when(heads(v.CHAPTER, "الفصل", "القسم"), "C").when(heads(v.ARTICLE, "المادة"), "A")
            .when(heads(v.ANNEX, *v.ANNEX_WORDS), "X").when(F.substring(line, 2, 1).isin(".", "-", ")") & line.rlike(v.LETTER), "r").when(heads(v.ORDINAL_PARAGRAPH, *v.ORDINAL_WORDS), "r").otherwise("t"))
    found = docs.select(key, F.posexplode(text.lines(F.coalesce(F.col(body), F.lit("")))).alias("pos", "raw"))
    return found.withColumn("line", text.strip(F.col("raw"))).withColumn("kind", kind).drop("raw")


def sections(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, display_order, section_type, section_number, section_label, parent_order, raw_text, list_position."""
    w = Window.partitionBy(key).orderBy("pos")
    upto, whole = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(key)
    hard = F.col("kind").isin("P", "C", "A", "X")
    df = lines(docs, key, body).withColumn("hard", hard)
    df = df.withColumn("last_hard", F.last(F.when(F.col("hard"), F.col("kind")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn("mark", F.col("hard") | ((F.col("kind") == "r") & (F.col("last_hard") == "A"))).withColumn("mark", F.coalesce("mark", F.lit(False)))
    df = df.withColumn("first_main", F.min(F.when(F.col("kind").isin("P", "C", "A"), F.col("pos"))).over(whole))
    early = F.col("first_main").isNull() | (F.col("pos") < F.col("first_main"))
    df = df.withColumn("preamble", early & ~F.col("mark") & (F.col("kind") != "b"))
    df = (df.withColumn("n_marks", F.sum(F.col("mark").cast("int")).over(whole))
          .withColumn("any_preamble", F.max("preamble").over(whole))
          .withColumn("early_annex", F.coalesce(F.max((F.col("kind") == "X") & (F.col("pos") < F.col("first_main"))).over(whole), F.lit(False))))
    df = df.withColumn("at_head", F.col("any_preamble") & F.col("first_main").isNotNull() & ~F.col("early_annex"))
    df = df.withColumn("seq", F.sum(F.col("mark").cast("int")).over(upto))
    shift = F.col("at_head").cast("int")
    df = df.withColumn("order", F.when(F.col("preamble"), F.when(F.col("at_head"), F.lit(0)).otherwise(F.col("n_marks") + 1)).otherwise(F.col("seq") + shift))
    last = lambda k: F.last(F.when(F.col("kind") == k, F.col("order")), ignorenulls=True).over(upto)
    df = df.withColumn("last_p", last("P")).withColumn("last_c", last("C")).withColumn("last_a", last("A"))
    inside = F.when(F.col("last_p").isNull() | (F.col("last_c") > F.col("last_p")), F.col("last_c")).otherwise(F.col("last_p"))
    parent = (F.when(~F.col("mark"), None).when(F.col("kind") == "C", F.col("last_p")).when(F.col("kind") == "A", F.coalesce(inside, "last_p"))
              .when(F.col("kind") == "r", F.col("last_a")))
    df = df.withColumn("parent", parent)
    # lines that no section takes: texts before any mark that aren't the preamble's, and blank ones there
    df = df.filter(F.col("preamble") | (F.col("seq") > 0))
    line = F.col("line")
    number = (F.when(F.col("kind") == "P", F.regexp_extract(line, v.PART, 2)).when(F.col("kind") == "C", F.regexp_extract(line, v.CHAPTER, 2))
              .when(F.col("kind") == "A", text.western_digits(F.regexp_extract(line, v.ARTICLE, 1)))
              .when(F.col("kind") == "r", F.coalesce(F.nullif(F.regexp_extract(line, v.LETTER, 1), F.lit("")), F.regexp_extract(line, v.ORDINAL_PARAGRAPH, 1))))
    first = lambda c: F.max(F.when(F.col("mark"), c))  # noqa: E731  one mark a section
    names = text.lookup({"P": "part", "C": "chapter", "A": "article", "X": "annex", "r": "paragraph"}, first(F.col("kind")))
    grouped = df.groupBy(key, F.col("order").alias("display_order"), "preamble").agg(
        names.alias("named"), first(number).alias("section_number"), first(line).alias("label"), first(F.col("parent")).alias("parent_order"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("joined"))
    return grouped.select(
        key, "display_order", F.when(F.col("preamble"), "preamble").otherwise(F.col("named")).alias("section_type"), "section_number",
        F.when(F.col("preamble"), v.PREAMBLE_LABEL).otherwise(F.col("label")).alias("section_label"), "parent_order",
        text.strip(F.col("joined")).alias("raw_text"), F.when(F.col("preamble"), 0).otherwise(F.col("display_order")).alias("list_position"))


def flags(c) -> dict:
    """Seven flags of a section's text; an exception alone doesn't make it relevant. First letters are met before edges of words and all alternatives."""
    out = {name: F.coalesce(c.rlike(f"(?=[{v.FLAG_LETTERS[name]}]){pattern}"), F.lit(False)) for name, pattern in v.FLAGS.items()}
    relevant = F.lit(False)
    for name, flag in out.items():
        if name != "contains_exception":
            relevant = relevant | flag
    return {"compliance_relevant": relevant, **out}


def build(found: DataFrame, slug: str = "doc_slug") -> DataFrame:
    """Section records: identifiers, parents, cleaned texts, flags and the number of words."""
    version = ids.version_id(F.col(slug))
    kinds = F.map_from_arrays(F.collect_list("display_order").over(Window.partitionBy(slug)), F.collect_list("section_type").over(Window.partitionBy(slug)))
    df = found.withColumn("kinds", kinds).withColumn("version_id", version)
    df = df.withColumn("section_id", ids.section_id(F.col("version_id"), F.col("section_type"), F.col("display_order")))
    parent = F.when(F.col("parent_order") > 0, ids.section_id(F.col("version_id"), F.element_at("kinds", F.col("parent_order")), F.col("parent_order")))
    df = df.withColumn("parent_section_id", parent).withColumn("original_text", text.for_display(F.col("raw_text"), page_markers=False))
    df = df.withColumn("normalized_text", text.for_search(F.col("original_text"))).withColumn("word_count", text.count_words(F.col("original_text")))
    return df.withColumns(flags(F.col("normalized_text"))).drop("kinds", "raw_text")
