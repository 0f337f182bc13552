"""Work that must not be done twice, and rules that must stay what they were."""

import random
import time
from functools import reduce

import pytest
from pyspark.sql import functions as F

from sijill.functions import text
from sijill.functions import values as v
from sijill.operators import records, topics, validate
from sijill.plans import catalogue
from sijill.plans.corpus import TAXONOMY
from sijill.plans.structure import structure

DIR = "/root/testdata/sf0.001"


def texts_made(df) -> int:
    """How often a plan makes the statutes' texts from the documents."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("lower(coalesce(text")


@pytest.mark.parametrize("name", ["t_model_fallback", "v_topics", "t_enhance_accept", "c_clean_log", "y_disconnected"])
def test_texts_are_gone_through_once(spark, name):
    assert texts_made(catalogue.queries()[name](spark, DIR)) == 1


@pytest.mark.parametrize("name", ["v_sections", "v_artifacts"])
def test_checks_do_not_build_sections_anew(spark, name):
    assert texts_made(catalogue.queries()[name](spark, DIR)) == 0  # they read what is checkpointed


def restated(c, search=True):
    """The cleaning rules one after the other, as plainly as can be."""
    sub = lambda p, to: lambda c: F.regexp_replace(c, p, to)
    replaced = lambda c: reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), v.ENTITIES, c)
    rules = [sub("<[^>]+>", " "), replaced, lambda c: F.translate(c, v.ZERO_WIDTH, ""), lambda c: F.translate(c, "ـ", ""), sub("[ً-ٟ]", ""), sub(r"(?U)\bصفحة\s+\d+\b", ""),
             sub(r"(?iU)\bPage\s+\d+\s+of\s+\d+\b", ""), sub(r"(?mdU)^\s*[-–]\s*\d+\s*[-–]\s*$", ""), sub("[ \t 　]+", " "), sub("\n{3,}", "\n\n"), sub(r"(?U)^\s+|\s+$", "")]
    if search:
        rules += [lambda c: F.translate(c, "٠١٢٣٤٥٦٧٨٩", "0123456789"), lambda c: F.translate(c, "آأإٱ", "اااا"), sub(r"ة(?![\p{L}\p{N}_])", "ه"), lambda c: F.translate(c, "ى", "ي")]
    return reduce(lambda c, r: r(c), rules, c)


def test_cleaning_as_restated(spark):
    rng = random.Random(3)
    bits = ["<", "<b>", ">", "&", "&amp;", "&lt;", "&nbsp;", "&#8206;", "amp;", "lt;", "​", "﻿", "­", "ـ", "ً", "ٟ", "٠", "ٰ", "٣", "5", "صفحة", "صفحة ", "ة", "Page", "PAGE", " of ", "of", "-", "–",
            " - ", "\n", "\n\n", "\n\n\n", " ", "  ", "\t", " ", "　", " ", "\r", "\u0085", "\u000b", "\u001c", "أ", "آ", "ٱ", "ا", "ى", "ي", "x", "_", "\n- 3 -\n", "Page 3 of 9", "صفحة 7"]
    made = [(None,), ("",)] + [("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))),) for _ in range(4000)]
    df, t = spark.createDataFrame(made, "t string"), F.col("t")
    df = df.select("t", restated(t).alias("n"), restated(t, search=False).alias("d"))
    wrong = df.filter(~text.normalize(t).eqNullSafe(F.col("n")) | ~text.for_display(t).eqNullSafe(F.col("d")) | ~text.for_search(F.col("d")).eqNullSafe(F.col("n"))
                      | ~text.normalize_again(F.col("n")).eqNullSafe(restated(F.col("n"))))
    assert wrong.collect() == []


def test_lines_as_restated(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n\r\nd\u0085 e\u001cf\n",), ("\r\n",), ("x\n\ny",), ("",), (None,)], "t string")
    plain = lambda s: None if s is None else s.splitlines() or []
    for r in df.select("t", text.lines(F.col("t")).alias("l")).collect():
        assert r.l == plain(r.t)


def test_cleaning_takes_less_time_than_its_rules_one_by_one(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("أبتثجحخدذرزسشصىطظعإفقكلمنة") for _ in range(6))
    df = spark.createDataFrame([(" ".join(word() for _ in range(20_000)),)] * 4, "t string").repartition(1).persist()
    df.count()

    def seconds(rule):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            df.select(F.length(rule(F.col("t")))).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(text.normalize) < 0.7 * seconds(restated)


def test_model_topics_by_case(spark):
    found = spark.createDataFrame([(1, "a", "A", 0, 0.45, ["x"]), (1, "b", "B", 1, 0.4, []), (2, "a", "A", 0, 0.9, []), (4, "m", "M", 0, 0.4, []), (4, "a", "A", 1, 0.4, [])],
                                  "doc_id long, topic_slug string, topic_name_ar string, topic_ord int, confidence double, matched_keywords array<string>")
    model = spark.createDataFrame([(1, "m", "M", 0.48), (2, "m", "M", 0.95), (3, "m", "M", 0.1), (4, "m", "M", 0.45), (5, "m", "M", 0.0)], "doc_id long, topic_slug string, topic_name_ar string, confidence double")
    out = topics.with_model(found, model)
    rows = sorted((r.doc_id, r.topic_slug, r.confidence, r.is_primary, r.extraction_method) for r in out.collect())
    assert rows == [(1, "a", 0.45, False, "keyword"), (1, "b", 0.4, False, "keyword"), (1, "m", 0.48, True, "model"), (2, "a", 0.9, True, "keyword"), (3, "m", 0.1, True, "model"),
                    (4, "a", 0.4, False, "keyword"), (4, "m", 0.45, True, "model")]
    assert out.columns == ["doc_id", "topic_slug", "topic_name_ar", "confidence", "is_primary", "extraction_method", "matched_keywords"]


def test_body_alone_can_reach_the_threshold(spark):
    taxonomy = [{"id": "t", "name_ar": "T", "keywords_ar": [f"كلمه{i}" for i in range(8)]}, {"id": "u", "name_ar": "U", "keywords_ar": [f"كلمه{i}" for i in range(7)]}]
    body = "س" * 900 + " " + " ".join(taxonomy[0]["keywords_ar"])
    df = spark.createDataFrame([(1, "x", body), (2, "كلمه0", body)], "doc_id long, title_ar string, normalized_text string")
    assert sorted((r.doc_id, r.topic_slug, r.confidence) for r in topics.scores(df, taxonomy).collect()) == [(1, "t", 0.4), (2, "t", 0.75), (2, "u", 0.7)]


def test_topic_checks_by_case(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_slug string")
    found = spark.createDataFrame([("a", True), ("b", True), ("b", True)], "doc_slug string, is_primary boolean")
    rows = sorted((r.doc_slug, r.check_name, r.passed, r.severity) for r in validate.topics(docs, found).collect())
    assert rows == [("a", "exactly_one_primary_topic", True, "warning"), ("b", "exactly_one_primary_topic", False, "warning"), ("c", "has_topic_assignments", False, "warning")]


def test_structure_makes_only_what_is_asked_for(spark):
    pages = catalogue.statutes(spark, DIR).select("doc_slug", "source_url", "title_ar", "text")
    tables = structure(pages, TAXONOMY)
    assert not tables.made and "sections" in tables and "cleaned" not in list(tables)
    names = {r.role for r in tables["document_entities"].collect()}
    assert names == {"issuer", "mentioned"} and set(tables.made) == {"cleaned", "document_entities"}
    assert tables["sections"] is tables["sections"] and tables["sections"].count() > 0


def test_latest_carries_a_text_once(spark):
    df = spark.createDataFrame([("a", "x", 1, "p"), ("a", "y", None, "q"), ("b", None, 2, "r")], "k string, t string, n int, o string")
    out = records.latest(df, ["k"], "t", "n")
    assert sorted(out.collect()) == [("a", "y", None, "q"), ("b", None, 2, "r")] and out.columns == ["k", "t", "n", "o"]
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()
    maps = df.withColumn("m", F.create_map("k", "o"))
    assert sorted(r.m["a"] for r in records.latest(maps, ["k"], "t").collect() if "a" in r.m) == ["q"]
