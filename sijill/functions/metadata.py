"""What titles, openings and listings say about a document: Columns to Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ids, text
from . import values as v

OPENING = 1500  # characters of the body that metadata comes from
ENTITY_OPENING = 400


def nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def doc_type(title: Column, url: Column | None = None, types=tuple(v.DOC_TYPES)) -> Column:
    """By the longest type word that a title begins with, else that stands in it as a word, else by the address."""
    t = text.remove_tatweel(text.strip(F.coalesce(title, F.lit(""))))
    order = sorted(types, key=lambda x: -len(x[0]))
    out = F.when(F.lit(False), F.lit(""))
    for word, kind in order:
        out = out.when(t.startswith(word), F.lit(kind))
    for word, kind in order:
        out = out.when(t.rlike(rf"(?U)(?:^|\s|ال){word}(?:\s|$)"), F.lit(kind))
    if url is not None:
        out = out.when(url.rlike(r"LegislationType=\d"), F.coalesce(text.lookup(v.URL_TYPES, F.regexp_extract(url, r"LegislationType=(\d+)", 1)), F.lit("unknown")))
    return out.otherwise(F.lit("unknown"))


def doc_number(c: Column) -> Column:
    return nonempty(text.western_digits(F.regexp_extract(c, v.NUMBER_YEAR, 1)))


def issue_year(c: Column) -> Column:
    """Year of the first number and year; a run of digits too long for a number gives none."""
    return nonempty(text.western_digits(F.regexp_extract(c, v.NUMBER_YEAR, 2))).try_cast("int")


def gazette_number(c: Column) -> Column:
    return nonempty(F.regexp_extract(c, v.GAZETTE, 1))


def dates(c: Column) -> Column:
    """Distinct dates, as year-month-day, in the order of their first mention; day before month unless only the other way is possible."""
    def iso(x):
        a, b, y = (text.western_digits(F.regexp_extract(x, v.DATE, g)).cast("int") for g in (1, 2, 3))
        month, day = F.when((b > 12) & (a <= 12), a).otherwise(b), F.when((b > 12) & (a <= 12), b).otherwise(a)
        good = y.between(1900, 2099) & month.between(1, 12) & day.between(1, 31)
        return F.when(good, F.format_string("%04d-%02d-%02d", y, month, day))

    return F.array_distinct(F.array_compact(F.transform(F.regexp_extract_all(c, F.lit(v.DATE), F.lit(0)), iso)))


def publication_date(d: Column) -> Column:
    return F.get(d, F.lit(0))


def effective_date(d: Column) -> Column:
    return F.coalesce(F.get(d, F.lit(1)), F.get(d, F.lit(0)))


def is_repeal(c: Column) -> Column:
    return c.rlike(v.REPEAL)


def is_amendment(c: Column) -> Column:
    return c.rlike(v.AMEND)


def status(c: Column) -> Column:
    return F.when(is_repeal(c), "repealed").when(is_amendment(c), "amended").otherwise("active")


def status_name(s: Column) -> Column:
    return F.coalesce(text.lookup(v.STATUS_NAMES, s), F.lit(""))


def listing_status(c: Column, default: str = "active") -> Column:
    return F.coalesce(text.lookup(v.STATUSES, text.strip(c)), F.lit(default))


def listing_type(c: Column, default: str = "law") -> Column:
    return F.coalesce(text.lookup(v.LISTING_TYPES, text.strip(c)), F.lit(default))


def listing_slug(doc_type_en: Column, year: Column, number: Column, legislation_id: Column) -> Column:
    """type-year-number if all are there, else the listing's id."""
    whole = (doc_type_en != "") & (year != 0) & (number != "")
    return F.when(whole, ids.doc_slug(doc_type_en, year, number)).otherwise(F.concat(F.lit("legislation-"), legislation_id.cast("string")))


def listing_type_word(type_id: Column) -> Column:
    """The listing's word for the number of a type; empty for other numbers."""
    return F.coalesce(text.lookup(v.LISTING_TYPE_IDS, type_id.cast("int")), F.lit(""))


def legal_basis(c: Column) -> Column:
    """The clauses in which a text names its basis."""
    return F.transform(F.regexp_extract_all(c, F.lit(v.LEGAL_BASIS), F.lit(0)), text.strip)


# pages

def without_tags(html: Column, tags=tuple(v.PAGE_FURNITURE)) -> Column:
    """A page without elements of some kinds; elements of one kind within another end at the first end tag."""
    for tag in tags:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b.*?</{tag}\s*>", "")
    return html


def inner(html: Column, tag: str) -> Column:
    """Text of the first element of a kind, on one line; null if there is none."""
    raw = F.when(html.rlike(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>"), F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))
    return text.strip(F.regexp_replace(text.strip_html(raw), r"(?U)\s+", " "))


def container(html: Column, attribute: str) -> Column:
    """What is inside the first div with an attribute (a pattern), up to its own end tag, other divs within it included; empty if there is none."""
    rest = F.regexp_extract(html, rf"(?is)<div\b[^>]*\s{attribute}[^>]*>(.*)\z", 1)
    pieces = F.split(rest, r"(?i)(?=<div\b|</div\s*>)")

    def step(s, piece):
        depth = s["depth"] + F.when(piece.rlike(r"(?i)^<div\b"), 1).when(piece.rlike(r"(?i)^</div"), -1).otherwise(0)
        inside = s["inside"] & (depth >= 0)
        return F.struct(depth.alias("depth"), inside.alias("inside"), (s["n"] + inside.cast("int")).alias("n"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("inside"), F.lit(0).alias("n"))
    return F.array_join(F.slice(pieces, F.lit(1), F.aggregate(pieces, start, step, lambda s: s["n"])), "")


def of_class(name: str) -> str:
    """Pattern of an attribute that names a class among others."""
    return rf"""class\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["']"""


def html_title(html: Column, header: str = v.TITLE_CONTAINER, classed=tuple(v.TITLE_CLASSES), tags=("h1", "h2")) -> Column:
    """The first heading in the header's container, an h3 before h2 and h1, else one of some class, else the first h1 or h2 that there is, else the first line in Arabic."""
    page = without_tags(html, v.PAGE_FURNITURE)
    top = container(page, of_class(header))
    special = [F.regexp_extract(page, rf"(?is)<{t}\b[^>]*\s{of_class(c)}[^>]*>(.*?)</{t}\s*>", 1) for t, c in classed]
    special = [nonempty(text.strip(F.regexp_replace(text.strip_html(x), r"(?U)\s+", " "))) for x in special]
    arabic = F.get(F.filter(F.transform(text.lines(text.strip_html(page)), text.strip), lambda x: (x != "") & text.contains_arabic(x)), F.lit(0))
    return F.coalesce(*[nonempty(inner(top, t)) for t in ("h3", "h2", "h1")], *special, *[inner(page, t) for t in tags], F.substring(arabic, 1, 200), F.lit(""))


def html_body(html: Column, containers=tuple(v.BODY_CONTAINERS)) -> Column:
    """Text of the first container in Arabic of over 100 characters, else of the whole body; blocks begin lines."""

    def lined(c):
        c = F.regexp_replace(c, r"(?i)<(br|p|div|li|tr)\b", "\n<$1")
        c = text.replace_all(F.regexp_replace(c, "<[^>]+>", "\n"), v.ENTITIES)
        return text.strip(F.regexp_replace(c, "\n{3,}", "\n\n"))

    page = without_tags(html, v.PAGE_FURNITURE)
    found = []
    for name in containers:
        body = lined(container(page, name if "=" in name else of_class(name)))
        found.append(F.when(text.contains_arabic(body) & (F.length(body) > 100), body))
    whole = F.regexp_extract(page, r"(?is)<body\b[^>]*>(.*)</body\s*>", 1)
    return F.coalesce(*found, lined(F.coalesce(nonempty(whole), page)))


def attachments(html: Column, site: Column) -> Column:
    """Links to files and to what is called an annex: url and label."""
    link = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>'
    pairs = F.transform(F.regexp_extract_all(html, F.lit(link), F.lit(0)), lambda x: F.struct(
        text.strip(F.regexp_extract(x, link, 1)).alias("h"), text.strip(F.regexp_replace(F.regexp_extract(x, link, 2), "<[^>]+>", "")).alias("l")))
    wanted = F.filter(pairs, lambda x: F.lower(x["h"]).endswith(".pdf") | x["l"].rlike("|".join(v.ATTACHMENT_WORDS)))

    def absolute(x):
        h = x["h"]
        url = F.when(h.startswith("http"), h).when(h.startswith("/"), F.concat(site, h)).otherwise(F.concat(site, F.lit("/"), h))
        return F.struct(url.alias("url"), F.coalesce(nonempty(x["l"]), F.lit("attachment")).alias("label"))

    return F.transform(wanted, absolute)
