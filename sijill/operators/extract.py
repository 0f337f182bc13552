"""Rows that texts mention: references, institutions, relationships, scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, metadata, text
from ..functions import values as v


def matches(c: Column, pattern: str, **groups: int) -> Column:
    """All matches of a pattern, with the wanted groups; the text is gone through once, groups come from the short matches, so the pattern must not look beyond a match."""
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda m: F.struct(*[(F.regexp_extract(m, pattern, g) if g else m).alias(name) for name, g in groups.items()]))


def references(c: Column) -> Column:
    """Other documents that a text names: token, doc_number, year, raw, target_slug; repeats stay."""
    found = matches(c, v.REFERENCE, raw=0, token=1, number=2, year=3)

    def built(x):
        number, year = text.western_digits(x["number"]), text.western_digits(x["year"])
        kind = F.coalesce(text.lookup(v.REFERENCE_TYPES, x["token"]), F.lit("doc"))
        return F.struct(x["token"].alias("token"), number.alias("doc_number"), year.alias("year"), x["raw"].alias("raw"),
                        F.concat(kind, F.lit("-"), year, F.lit("-"), number).alias("target_slug"))

    return F.transform(found, built)


def section_references(c: Column) -> Column:
    """Articles and paragraphs that a text names: ref_text, article_number, ref_type; the first of each ref_text."""
    found = matches(c, v.SECTION_REFERENCE, raw=0, number=1, context=2)

    def built(x):
        same = x["context"].rlike("هذا القانون|هذا النظام|أعلاه|أدناه")
        kind = F.when(same, "same_law").when(x["context"].contains("الدستور"), "constitution").otherwise("article_reference")
        return F.struct(text.strip(x["raw"]).alias("ref_text"), text.western_digits(x["number"]).alias("article_number"), kind.alias("ref_type"))

    # what follows a text settles its number and kind, so distinct structs are distinct texts
    return F.array_distinct(F.filter(F.transform(found, built), lambda x: F.length(x["article_number"]) <= 5))


def bad_word(w: Column, i: Column) -> Column:
    """Whether a word after the first ends the name of an institution."""
    definite = w.startswith("ال") | w.startswith("وال")
    suffix = F.lit(False)
    for s in v.ENTITY_SUFFIXES:
        suffix = suffix | w.endswith(s)
    several = F.length(w) > 1
    return (i > 0) & (w.isin(*v.ENTITY_STOP) | (several & w.rlike("^[بلفك]")) | (several & w.startswith("و") & ~w.startswith("وال"))
                      | ((i >= 2) & ~definite) | suffix)


def trimmed_name(c: Column) -> Column:
    """The name within what a pattern caught, null if it isn't one."""
    head = text.strip(F.get(F.split(text.strip(c), "[،؋؛؟;,]+"), F.lit(0)))
    head = text.strip(F.regexp_replace(head, r"[,.()\[\]:؋]+$", ""))
    words = F.filter(F.split(head, r"(?U)\s+"), lambda w: w != "")
    end = F.array_position(F.transform(words, bad_word), F.lit(True))
    words = F.slice(words, F.lit(1), F.when(end > 0, end - 1).otherwise(F.size(words)).cast("int"))
    name = F.array_join(words, " ")
    good = F.size(words).between(2, 4) & F.length(name).between(5, 70) & ~F.exists(words, lambda w: w.isin(*v.ENTITY_BAD))
    return F.when(good, name)


def named_institutions(c: Column) -> Column:
    """Institutions of a text as entity_type and entity_name_ar, kinds in their order, then the text's; repeats stay."""
    def named(kind: str, first: str) -> Column:
        letters = "".join(w[0] for w in first.removeprefix("(?:").split("|"))  # these are met before the edge of a word
        caught = F.regexp_extract_all(c, F.lit(rf"(?U)(?=[{letters}])\b{first}\s+{v.ENTITY_WORD}(?:\s+{v.ENTITY_WORD}){{0,2}}"), F.lit(0))
        return F.transform(caught, lambda m: F.struct(F.lit(kind).alias("entity_type"), trimmed_name(m).alias("entity_name_ar")))

    return F.filter(F.concat(*[named(kind, first) for kind, first in v.ENTITY_KINDS]), lambda e: e["entity_name_ar"].isNotNull())


def issuing_name(title: Column, body: Column) -> Column:
    """The institution that a document's title and the opening of its text name first; kinds are looked for in their order."""
    return F.get(named_institutions(F.concat_ws("\n", title, F.substring(body, 1, metadata.ENTITY_OPENING))), F.lit(0))["entity_name_ar"]


def entities(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Institutions: key, entity_name_ar, entity_type, place (kinds in their order, then the text's), role; the first of each name in a document."""
    found = docs.select(key, F.posexplode(named_institutions(F.col(body))).alias("place", "e")).select(key, "place", "e.*")
    by_name = Window.partitionBy(key, "entity_name_ar").orderBy("place")
    found = found.withColumn("n", F.row_number().over(by_name)).filter("n = 1").drop("n")
    role = F.when(F.row_number().over(Window.partitionBy(key).orderBy("place")) == 1, "issuer").otherwise("mentioned")
    return found.withColumn("role", role)


def entity_records(found: DataFrame) -> DataFrame:
    """One row for each institution of the corpus."""
    s = ids.entity_slug(F.col("entity_name_ar"), F.col("entity_type"))
    return found.select(ids.entity_id(s).alias("entity_id"), s.alias("entity_slug"), "entity_name_ar", "entity_type").dropDuplicates(["entity_id"])


def merged(found: DataFrame, table: dict[str, str] | None = None) -> DataFrame:
    """Institutions by their canonical names, each once a document."""
    table = v.ENTITY_MERGES if table is None else table
    name = F.coalesce(text.lookup(table, F.col("entity_name_ar")), F.col("entity_name_ar"))
    keys = [c for c in found.columns if c not in ("entity_name_ar", "entity_type", "place", "role")]
    renamed = found.withColumn("entity_name_ar", name)
    return renamed.groupBy(*keys, "entity_name_ar").agg(F.min_by(F.struct("entity_type", "place", "role"), "place").alias("f")).select(*keys, "entity_name_ar", "f.*")


def deduplicated(found: DataFrame, table: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """A merge of institutions' names over roles (doc_slug, entity_name_ar, entity_type, place, role): roles with identifiers made anew, each once a document; the issuer of each document; numbers of names before and after."""
    roles = merged(found, table).withColumn("doc_id", ids.doc_id(F.col("doc_slug"))).withColumn("entity_slug", ids.entity_slug(F.col("entity_name_ar"), F.col("entity_type")))
    roles = roles.withColumn("entity_id", ids.entity_id(F.col("entity_slug"))).withColumn("role_id", ids.role_id(F.col("doc_id"), F.col("entity_id"), F.col("role")))
    issuers = roles.filter("role = 'issuer'").select("doc_slug", F.col("entity_id").alias("issuing_entity_id"), F.col("entity_name_ar").alias("issuing_entity_name_ar"))
    names = found.agg(F.count_distinct("entity_name_ar").alias("names_before")).crossJoin(roles.agg(F.count_distinct("entity_name_ar").alias("names_after")))  # one row each
    return {"roles": roles, "issuers": issuers, "counts": names.withColumn("net_reduction", F.col("names_before") - F.col("names_after"))}


def relationships(docs: DataFrame, slug: str = "doc_slug", body: str = "text") -> DataFrame:
    """Links between documents: rel_id, source and target slugs and ids, rel_type, extracted_text, confidence; the first of each target and kind."""
    c = F.col(body)
    clause = lambda x: F.transform(references(x), lambda r: F.struct(r["target_slug"].alias("target"), F.lit("BASED_ON").alias("kind"), F.substring(x, 1, 300).alias("said"), F.lit(85).alias("points")))
    constitution = lambda x: F.array(F.struct(F.lit(v.CONSTITUTION).alias("target"), F.lit("BASED_ON").alias("kind"), F.substring(x, 1, 300).alias("said"), F.lit(90).alias("points")))
    none = F.slice(constitution(F.lit("")), F.lit(1), F.lit(0))
    based = F.flatten(F.transform(metadata.legal_basis(c), lambda x: F.concat(clause(x), F.when(x.contains("الدستور"), constitution(x)).otherwise(none))))
    df = docs.select(slug, based.alias("based"), references(c).alias("refs"), metadata.is_repeal(c).alias("repeal"), metadata.is_amendment(c).alias("amend"))
    n = F.size("refs")
    kind = F.when(F.col("repeal") & (n <= 3), "REPEALS").when(F.col("amend") & (n <= 5), "AMENDS").otherwise("REFERS_TO")
    points = F.when(kind == "REFERS_TO", 60).otherwise(80)
    named = F.transform(F.filter("refs", lambda r: r["target_slug"] != F.col(slug)), lambda r: F.struct(r["target_slug"].alias("target"), kind.alias("kind"), r["raw"].alias("said"), points.alias("points")))
    df = df.select(slug, F.posexplode(F.concat("based", named)).alias("pos", "r")).select(slug, "pos", "r.*").filter("points >= 50")
    w = Window.partitionBy(slug, "kind", "target").orderBy("pos")
    df = df.withColumn("n", F.row_number().over(w)).filter("n = 1")
    return df.select(ids.relationship_id(F.col(slug), F.col("kind"), F.col("target")).alias("rel_id"), ids.doc_id(F.col(slug)).alias("source_doc_id"),
                     F.col(slug).alias("source_doc_slug"), ids.doc_id(F.col("target")).alias("target_doc_id"), F.col("target").alias("target_doc_slug"),
                     F.col("kind").alias("rel_type"), F.col("said").alias("extracted_text"), (F.col("points") / 100).alias("confidence"))


def scope(c: Column) -> Column:
    """Whom a document is for, by its first thousand characters."""
    opening = F.substring(c, 1, 1000)
    near = F.substring(opening, 1, 500)
    any_entity = F.lit(False)
    for _, first in v.ENTITY_KINDS:
        named = F.transform(F.regexp_extract_all(near, F.lit(rf"(?U)\b{first}\s+{v.ENTITY_WORD}(?:\s+{v.ENTITY_WORD}){{0,2}}"), F.lit(0)), trimmed_name)
        any_entity = any_entity | F.exists(named, lambda x: x.isNotNull())
    return F.when(opening.rlike(v.SCOPE_GOVERNMENT), "government_wide").when(opening.rlike(v.SCOPE_GENERAL), "general").when(any_entity, "entity_specific").otherwise("unknown")
