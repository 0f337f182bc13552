"""Cleaning rules: Column to Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as v

#: Rules of a document's cleaning in their order; the last four make the copy for search.
DISPLAY_RULES = ("strip_html", "remove_zero_width", "remove_tatweel", "remove_harakat", "remove_page_markers", "normalize_spaces")
SEARCH_RULES = ("western_digits", "normalize_alef", "normalize_tamarbouta", "normalize_yeh")
SEARCH_FROM, SEARCH_TO = v.DIGITS_FROM + v.ALEF_FROM + "ى", v.DIGITS_TO + v.ALEF_TO + "ي"


def bound(c: Column, f) -> Column:
    """f(c), where f may name its argument many times: c is worked out once, and the expression stays short."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def where(c: Column, needed, change) -> Column:
    """change(c) where a cheap test says that it may change something, else c as it is."""
    return bound(c, lambda x: F.when(needed(x), change(x)).otherwise(x))


def holds(*words: str):
    """A test for texts that hold one of some words."""
    return lambda x: reduce(Column.__or__, [F.contains(x, F.lit(w)) for w in words])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(v.WHITE_SPACE))


def replace_all(c: Column, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_html(c: Column) -> Column:
    """Tags become spaces; then entities are decoded one after the other, so what &amp; reveals is decoded too."""
    c = where(c, holds("<"), lambda x: F.regexp_replace(x, "<[^>]+>", " "))
    return where(c, holds("&"), lambda x: replace_all(x, v.ENTITIES))


def lines(c: Column) -> Column:
    """Lines of a text; an empty last piece is none."""
    return bound(F.split(c, v.LINE_END), lambda pieces: F.when(F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces))


def remove_artifact_lines(c: Column, phrases=tuple(v.ARTIFACT_LINES)) -> Column:
    return F.array_join(F.filter(lines(c), lambda x: ~strip(x).isin(*phrases)), "\n")


def remove_zero_width(c: Column) -> Column:
    return where(c, lambda x: x.rlike(one_of(v.ZERO_WIDTH)), lambda x: replace_all(x, [(z, "") for z in v.ZERO_WIDTH]))


def remove_tatweel(c: Column) -> Column:
    return F.replace(c, F.lit(v.TATWEEL), F.lit(""))


def remove_harakat(c: Column) -> Column:
    return F.regexp_replace(c, v.HARAKAT, "")


def remove_page_markers(c: Column) -> Column:
    """Marks are looked for only in texts that hold their words; a letter is met before the edge of a word, which takes longer."""
    c = where(c, holds("صفحة"), lambda x: F.regexp_replace(x, r"(?U)(?=ص)\bصفحة\s+\d+\b", ""))
    c = where(c, holds("P", "p"), lambda x: F.regexp_replace(x, r"(?iU)(?=P)\bPage\s+\d+\s+of\s+\d+\b", ""))
    return where(c, holds("-", "–"), lambda x: F.regexp_replace(x, r"(?mdU)^\s*[-–]\s*\d+\s*[-–]\s*$", ""))


def normalize_spaces(c: Column) -> Column:
    """Single spaces are left as they are, other runs become one."""
    c = where(c, holds("  ", *v.SPACES[1:]), lambda x: F.regexp_replace(x, f"[{v.SPACES}](?:(?<! )|(?=[{v.SPACES}]))[{v.SPACES}]*", " "))
    return strip(where(c, holds("\n\n\n"), lambda x: F.regexp_replace(x, "\n{3,}", "\n\n")))


def western_digits(c: Column) -> Column:
    return translated(c, v.DIGITS_FROM, v.DIGITS_TO)


def normalize_alef(c: Column) -> Column:
    return replace_all(c, zip(v.ALEF_FROM, v.ALEF_TO))


def normalize_tamarbouta(c: Column) -> Column:
    """At the end of words only."""
    return where(c, holds("ة"), lambda x: F.regexp_replace(x, r"ة(?![\p{L}\p{N}_])", "ه"))


def normalize_yeh(c: Column) -> Column:
    return F.replace(c, F.lit("ى"), F.lit("ي"))


def rule(name: str):
    return globals()[name]


def one_of(letters: str) -> str:
    """Pattern of any of some letters, in few ranges: each range takes time at each letter of a text."""
    codes = sorted(set(map(ord, letters)))
    first = [c for c in codes if c - 1 not in codes]
    last = [c for c in codes if c + 1 not in codes]
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(first, last)) + "]"


def translated(c: Column, of: str, to: str) -> Column:
    """Each letter of `of` becomes that of `to` or goes; texts that hold none are only looked through."""
    return where(c, lambda x: x.rlike(one_of(of)), lambda x: F.translate(x, of, to))


def for_display(c: Column, page_markers: bool = True, more: tuple[str, str] = ("", "")) -> Column:
    """A document's text for reading, by DISPLAY_RULES; sections keep page markers.

    Zero-width marks, tatweel and harakat go in one pass. Letters of the first of `more` become those of
    the second in the same pass, so these must make no difference to the rules after it.
    """
    of, to = more
    c = translated(strip_html(c), of + v.ZERO_WIDTH + v.TATWEEL + v.HARAKAT_LETTERS, to)
    return normalize_spaces(remove_page_markers(c) if page_markers else c)


def for_search(c: Column) -> Column:
    """The copy for search of a text for reading, by SEARCH_RULES; the end of a word is the same before and after the translation."""
    return normalize_tamarbouta(translated(c, SEARCH_FROM, SEARCH_TO))


def normalize(c: Column, search: bool = True) -> Column:
    """What for_search makes of for_display; digits stay digits and letters letters, so all is translated in one pass, before page marks and spaces."""
    return normalize_tamarbouta(for_display(c, more=(SEARCH_FROM, SEARCH_TO))) if search else for_display(c, more=(v.DIGITS_FROM, v.DIGITS_TO))


def normalize_again(c: Column) -> Column:
    """normalize of what normalize has made: all but tags, entities and page marks is settled, and these are seldom left."""
    return bound(c, lambda x: bound(remove_page_markers(strip_html(x)), lambda y: F.when(x == y, x).otherwise(normalize(x))))


def begins(c: Column, *words: str) -> Column:
    return reduce(Column.__or__, [c.startswith(w) for w in words])


def contains_arabic(c: Column) -> Column:
    return F.coalesce(c.rlike("[؀-ۿ]"), F.lit(False))


def count_words(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))


def ordinal_to_int(c: Column) -> Column:
    return lookup(v.ORDINAL_NUMBERS, strip(c))


def lookup(table: dict, c: Column) -> Column:
    """The table's value for c, null where there is none."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def sanity_warnings(c: Column) -> Column:
    """What is odd about a cleaned text."""
    return F.array_compact(F.array(
        F.when(~contains_arabic(c), F.lit("CRITICAL: no Arabic")),
        F.when(F.length(c) < 200, F.lit("WARN: short text")),
        F.when(~F.contains(c, F.lit("المادة")), F.lit("WARN: no article"))))


def clean(df, text: str = "text"):
    """df with original_text, normalized_text, warnings and cleaning_log: each rule with the characters before and after it."""
    rules = (*DISPLAY_RULES, *SEARCH_RULES)
    own, kept = df.columns, len(DISPLAY_RULES)
    df = df.withColumn("_stage0", F.col(text))
    for i, n in enumerate(rules):  # a projection each, so that a text is worked out once; of earlier stages only lengths are carried on
        before = [c for c in df.columns if c != f"_stage{i}" or i == kept]
        df = df.select(*before, F.length(f"_stage{i}").alias(f"_n{i}"), rule(n)(F.col(f"_stage{i}")).alias(f"_stage{i + 1}"))
    df = df.withColumn(f"_n{len(rules)}", F.length(f"_stage{len(rules)}"))
    at = lambda i: F.col(f"_n{i}")
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), at(i).alias("chars_before"), at(i + 1).alias("chars_after"), (at(i) - at(i + 1)).alias("changes"), F.lit("").alias("note")) for i, n in enumerate(rules)])
    original = F.col(f"_stage{kept}")
    made = {"original_text": original, "normalized_text": F.col(f"_stage{len(rules)}"), "cleaning_log": entries, "warnings": sanity_warnings(original)}
    return df.select(*[c for c in own if c not in made], *[c.alias(n) for n, c in made.items()])


def log_entries(df, *keys: str):
    """keys and the entries of cleaning_log, a row each.

    What is exploded isn't the column itself: Spark would then ask below all stages whether it has
    entries, and for that work out each stage from the first text anew.
    """
    return df.select(*keys, F.explode(F.filter("cleaning_log", lambda x: x["rule"].isNotNull())).alias("l")).select(*keys, "l.*")


def log_line(log: Column, warnings: Column) -> Column:
    """rules, changes in sum, and warnings of a cleaning log."""
    return F.struct(F.size(log).alias("rules"), F.aggregate(log, F.lit(0), lambda a, x: a + x["changes"]).alias("changes"),
                    F.array_join(warnings, "; ").alias("warnings"))
