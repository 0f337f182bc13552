"""Identifiers, all as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as v
from .text import lookup


def uuid5(kind: str, name: Column) -> Column:
    """Name-based identifier in the name space of a kind of record."""
    h = F.sha1(F.concat(F.unhex(F.lit(v.NAMESPACES[kind])), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def doc_slug(doc_type: Column, year: Column, number: Column, title_slug: Column | None = None) -> Column:
    """type-year-number; a number that isn't one is slugged, and without any the title or unknown stands in."""
    head = F.concat(F.replace(F.lower(doc_type), F.lit("_"), F.lit("-")), F.lit("-"), year.cast("string"), F.lit("-"))
    title = F.lit(None).cast("string") if title_slug is None else F.when(title_slug != "", F.substring(title_slug, 1, 40))
    return F.when(F.trim(number).rlike("^[0-9]+$"), F.concat(head, F.trim(number))).when(
        number != "", F.concat(head, F.substring(slug(number), 1, 20))).otherwise(F.concat(head, F.coalesce(title, F.lit("unknown"))))


def slug(c: Column) -> Column:
    kept = F.trim(F.regexp_replace(c, r"(?U)[^\w\s-]", ""))
    return F.lower(F.substring(F.regexp_replace(kept, r"(?U)\s+", "-"), 1, 60))


def doc_id(s: Column) -> Column:
    return uuid5("document", s)


def version_id(s: Column, number: Column | int = 1) -> Column:
    return F.concat(s, F.lit("-v"), (F.lit(number) if isinstance(number, int) else number).cast("string"))


def section_id(version: Column, section_type: Column, order: Column) -> Column:
    return F.concat(version, F.lit("-"), F.coalesce(lookup(v.SECTION_CODES, section_type), F.substring(section_type, 1, 3)), F.lit("-"), F.format_string("%04d", order))


def entity_slug(name: Column, kind: Column) -> Column:
    """The kind and a digest of the name: the same in every process."""
    return F.concat(kind, F.lit("-"), F.substring(F.sha1(F.encode(name, "UTF-8")), 1, 12))


def entity_id(s: Column) -> Column:
    return F.concat(F.lit("entity-"), s)


def topic_id(s: Column) -> Column:
    return F.concat(F.lit("topic-"), s)


def relationship_id(source: Column, kind: Column, target: Column) -> Column:
    return uuid5("relationship", F.concat(source, F.lit("-"), kind, F.lit("-"), target))


def assignment_id(doc: Column, topic: Column) -> Column:
    return uuid5("topic", F.concat(doc, F.lit("::"), topic))


def role_id(doc: Column, entity: Column, role: Column) -> Column:
    return uuid5("entity", F.concat(doc, F.lit("::"), entity, F.lit("::"), role))


def fetch_id(url: Column, timestamp: Column) -> Column:
    return F.concat(F.lit("fetch-"), F.substring(F.replace(uuid5("fetch", F.concat(url, F.lit("_"), timestamp)), F.lit("-"), F.lit("")), 1, 12))
