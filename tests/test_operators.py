"""Operators on small inputs: what each case must give."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from sijill.functions import ids, metadata, text
from sijill.operators import export, extract, graph, records, segment, topics, validate
from sijill.plans.corpus import TAXONOMY
from sijill.plans.structure import structure
from sijill.sources import files
from sijill.streaming import ingest


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize("rule,before,after", [
    ("strip_html", "<b>a</b>&amp;lt;&nbsp;", " a < "), ("remove_zero_width", "a​b﻿", "ab"), ("remove_tatweel", "قانــون", "قانون"),
    ("remove_harakat", "قَانُون", "قانون"), ("normalize_spaces", "  a \t b\n\n\n\nc ", "a b\n\nc"), ("western_digits", "٢٠١٤", "2014"), ("normalize_alef", "أإآٱ", "اااا"),
    ("normalize_tamarbouta", "مادة مادةx", "ماده مادةx"), ("normalize_yeh", "على", "علي"), ("remove_page_markers", "صفحة 3\nPage 1 of 2\n- 4 -", ""), ("strip_html", None, None),
])
def test_rules(spark, rule, before, after):
    assert one(spark, text.rule(rule), before) == after


def test_artifact_lines_and_words(spark):
    assert one(spark, text.remove_artifact_lines, "a\n ارتباطات المادة \nb\n") == "a\nb"
    assert one(spark, text.count_words, " a b \n c ") == 3 and one(spark, text.count_words, "") == 0
    assert one(spark, text.ordinal_to_int, "الثاني عشر") == 12 and one(spark, text.ordinal_to_int, "x") is None


@pytest.mark.parametrize("title,url,kind", [
    ("قانون الصحة", "", "law"), ("القانون المدني", "", "law"), ("قانــون العمل", "", "law"), ("مرسوم ملكي", "", "royal_decree"), ("مشروع نظام جديد", "", "regulation"), ("", "", "unknown"),
    ("وثيقة", "x?LegislationType=3", "instructions"), ("وثيقة", "x?LegislationType=99", "unknown"), ("دستور المملكة", "", "constitution"), ("قانونية", "", "law"),
])
def test_doc_type(spark, title, url, kind):
    assert one(spark, metadata.doc_type, title, url) == kind


def test_numbers_dates_status(spark):
    assert one(spark, metadata.doc_number, "قانون رقم (٣٤) لسنة ٢٠١٤") == "34" and one(spark, metadata.issue_year, "قانون رقم 5 لسنة 1999") == 1999
    assert one(spark, metadata.doc_number, "قانون") is None
    assert one(spark, metadata.dates, "04/30/2025 30/04/2025 1-2-1999 31/31/2000 1/1/1800 31/02/2001") == ["2025-04-30", "1999-02-01", "2001-02-31"]
    assert one(spark, metadata.status, "يُلغى القانون") == "repealed" and one(spark, metadata.status, "التعديل") == "amended" and one(spark, metadata.status, "x") == "active"
    assert one(spark, metadata.listing_status, "غير ساري") == "repealed" and one(spark, metadata.listing_status, "?") == "active"
    assert one(spark, lambda c: metadata.listing_status(c, "unknown"), "?") == "unknown"
    assert one(spark, metadata.legal_basis, "بمقتضى المادة (31) من الدستور\nx") == ["بمقتضى المادة (31) من الدستور"]


def test_identifiers(spark):
    slug = "law-1966-12"
    assert one(spark, ids.doc_id, slug) == str(uuid.uuid5(uuid.NAMESPACE_DNS, slug))
    assert one(spark, lambda c: ids.section_id(ids.version_id(c), F.lit("article"), F.lit(3)), slug) == "law-1966-12-v1-art-0003"
    assert one(spark, lambda a, b: ids.entity_slug(a, b), "وزارة", "ministry") == one(spark, lambda a, b: ids.entity_slug(a, b), "وزارة", "ministry")


@pytest.mark.parametrize("said,names", [
    ("تتولى وزارة المالية من الغد", ["وزارة المالية"]), ("مجلس الوزراء؛ ثم", ["مجلس الوزراء"]), ("مجلس الوزراء مجلس الوزراء", ["مجلس الوزراء"]),
    ("وزارة الصناعة والتجارة والتموين", ["وزارة الصناعة والتجارة والتموين"]), ("الوزارة المالية", []), ("مجلس بموافقة", []), ("محكمة العدل العليا تقرر", ["محكمة العدل العليا"]), ("", []),
    ("دائرة الجمارك ووزارة", ["دائرة الجمارك"]), ("هيئة قطرها", []),
])
def test_entities(spark, said, names):
    df = spark.createDataFrame([(1, said)], "doc_id long, text string")
    found = extract.entities(df).orderBy("place").collect()
    assert [r.entity_name_ar for r in found] == names
    kinds = {"وزارة": "ministry", "مجلس": "council", "محكمة": "court", "دائرة": "department"}
    assert [r.entity_type for r in found] == [kinds[n.split()[0]] for n in names]
    assert [r.role for r in found] == ["issuer", "mentioned"][: len(names)]


def sections_of(spark, said):
    df = spark.createDataFrame([("d", said)], "doc_id string, text string")
    rows = segment.sections(df).orderBy("list_position").collect()
    return [(r.section_type, r.section_number, r.display_order, r.parent_order, r.raw_text) for r in rows]


def test_sections(spark):
    got = sections_of(spark, "مقدمة\n\nالمادة (1)\nنص\nأ- أول\nب- ثان\nالمادة ٢\nتكملة")
    assert [x[:4] for x in got] == [("preamble", None, 0, None), ("article", "1", 2, None), ("paragraph", "أ", 3, 2), ("paragraph", "ب", 4, 2), ("article", "2", 5, None)]
    assert got[1][4] == "المادة (1)\nنص" and got[0][4] == "مقدمة"
    assert [x[:2] for x in sections_of(spark, "المادة 1\nأ- x\nب- y")] == [("article", "1"), ("paragraph", "أ"), ("paragraph", "ب")]
    assert sections_of(spark, "") == []


def restated(kinds):
    """The scan of lines, line by line: (type, order, parent, lines) of each section."""
    out, pre, done, order, opened = [], [], False, 0, None
    last = {"P": None, "C": None, "A": None}
    for i, k in enumerate(kinds):
        mark = k in "PCAX" or k == "r" and opened is not None and opened[0] in ("A", "r")
        if not mark:
            if not done:
                pre.append(i)
            elif opened:
                opened[3].append(i)
            continue
        if k in "PCA" and not done:
            done = True
            if pre:
                if order == 0:
                    out.append(("preamble", 0, None, pre))
                    order = 1
                    pre = []
        order += 1
        parent = {"P": None, "X": None, "C": last["P"], "r": last["A"]}.get(k)
        if k == "A":
            parent = last["C"] if last["C"] is not None and (last["P"] is None or last["C"] > last["P"]) else last["P"]
        opened = (k, order, parent, [i])
        out.append(opened)
        if k in last:
            last[k] = order
    if pre and not any(x[0] == "preamble" for x in out):
        out.append(("preamble", order + 1, None, pre))
    return sorted((a, b, c, tuple(d)) for a, b, c, d in out)


def test_sections_as_restated(spark):
    lines = {"P": "الباب الأول", "C": "الفصل الأول", "A": "المادة 1", "X": "ملحق 1", "r": "أ- نص", "t": "نص"}
    draw = random.Random(5)
    cases = ["".join(draw.choice("PCAXrt") for _ in range(draw.randint(1, 12))) for _ in range(400)]
    # an early annex's own lines are the preamble's, which the restatement keeps apart
    df = spark.createDataFrame([(i, "\n".join(f"{lines[k]} {j}" for j, k in enumerate(c))) for i, c in enumerate(cases)], "doc_id long, text string")
    names = {"part": "P", "chapter": "C", "article": "A", "annex": "X", "paragraph": "r", "preamble": "preamble"}
    got: dict = {}
    for r in segment.sections(df).collect():
        members = tuple(int(x.rsplit(" ", 1)[1]) for x in r.raw_text.split("\n"))
        got.setdefault(r.doc_id, []).append((names[r.section_type], r.display_order, r.parent_order, members))
    for i, c in enumerate(cases):
        assert sorted(got.get(i, []), key=str) == sorted(restated(c), key=str), c


def test_topics(spark):
    df = spark.createDataFrame([(1, "قانون الصحة العامة", "نص"), (2, "x", "البيئة"), (3, None, None), (4, "النقل", "ضريبة الدخل والمالية وضريبة")], "doc_id long, title_ar string, normalized_text string")
    rows = {(r.doc_id, r.topic_slug): r for r in topics.ranked(topics.scores(df, TAXONOMY)).collect()}
    assert rows[1, "health-law"].confidence == 0.8 and rows[1, "health-law"].is_primary
    assert (2, "environmental-law") not in rows and not any(k[0] == 3 for k in rows)
    assert rows[4, "transport-law"].confidence == 0.4 and rows[4, "tax-financial-law"].is_primary
    answer = topics.parsed_decision(F.col("c0"))
    assert one(spark, lambda c: topics.parsed_decision(c), '```json\n{"topic_id":"topic-civil-law","confidence":0.95}\n```').topic_id == "civil-law"
    assert one(spark, lambda c: topics.parsed_decision(c), '{"confidence":1}') is None and answer is not None


def test_validation_and_records(spark):
    docs = spark.createDataFrame([("a", "1", "قانون", "law", "active", "http://x", "5", None, None, "بمقتضى كذا"), ("b", "2", " ", "law", "void", "ftp", None, None, "y", "z")],
                                 "doc_slug string, doc_id string, title_ar string, doc_type string, status string, source_url string, official_gazette_number string, publication_date string, legal_basis_text string, original_text string")
    bad = {(r.doc_slug, r.check_name) for r in validate.documents(docs).filter("not passed").collect()}
    assert bad == {("b", "required_field_title_ar"), ("b", "title_contains_arabic"), ("b", "status_valid"), ("b", "source_url_format")}
    assert {(r.doc_slug, r.check_name) for r in validate.metadata(docs).collect()} == {("a", "missing_publication_date"), ("a", "missing_legal_basis_text")}
    present = spark.createDataFrame([("x.json",)], "path string")
    named = docs.withColumn("clean_json_path", F.when(F.col("doc_slug") == "a", "x.json").otherwise("y.json"))
    assert {r.doc_slug: r.passed for r in validate.files(named, present, "clean_json_path").collect()} == {"a": True, "b": False}
    empty = records.batch_report(spark.createDataFrame([], "success boolean, skipped boolean, d boolean"), pct="d").first()
    assert empty.pct == 0.0 and empty.scraped == 0
    raw = spark.createDataFrame([(7, " قانون ", "3", 2001, "ملغى", 2, "قانون"), (7, "قانون", "3", 2001, "ملغى", 2, "قانون"), (8, "n", None, None, None, None, None)],
                                "pmk_ID int, Name string, Number string, Year int, Status_AR string, Type int, TypeArName string")
    rows = {r.legislation_id: r for r in records.listing(raw).collect()}
    assert len(rows) == 2 and rows["7"].doc_slug == "law-2001-3" and rows["7"].status_normalized == "repealed" and rows["8"].doc_slug == "legislation-8"


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "d"), ("x", "y"), ("y", "x")], "source string, target string").withColumn("rel_type", F.lit("REPEALS"))
    assert sorted(tuple(r) for r in graph.repeal_chains(e).collect()) == [("a", "c", 2), ("b", "c", 1)]


def test_repeal_chains_of_any_length(spark):
    rows = [(f"n{i:03}", f"n{i + 1:03}", "REPEALS") for i in range(300)] + [("n000", "n000", "REPEALS"), ("a", "b", "REPEALS"), ("b", "a", "REPEALS"), ("b", "n299", "REPEALS")]
    got = sorted(tuple(r) for r in graph.repeal_chains(spark.createDataFrame(rows, "source string, target string, rel_type string")).collect())
    assert got == sorted([(f"n{i:03}", "n300", 300 - i) for i in range(300)] + [("n000", "n300", 301), ("a", "n300", 3), ("b", "n300", 2)])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("s", None, True, ["أ", "b"], 0.5)], "assignment_id string, doc_id string, is_primary boolean, matched_keywords array<string>, confidence double")
    whole = export.relational(df, "document_topics")
    assert whole.columns == export.RELATIONAL["document_topics"]
    export.write_csv(whole, str(tmp_path / "t"))
    row = spark.read.option("header", True).option("sep", "|").csv(str(tmp_path / "t")).first()
    assert row.is_primary == "true" and row.matched_keywords == '["أ","b"]' and row.doc_id in (None, "")
    assert export.nodes(spark.createDataFrame([("t", "x", "n", 1)], "topic_id string, topic_slug string, topic_name_ar string, topic_level int"), "topic").columns[0] == ":ID(topic)"
    assert export.empty_edges(spark).count() == 0


def test_structure_and_sources(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    body = "المادة 1\n" + "نص القانون وزارة العدل تنفذ. " * 10
    (folder / "law-2001-3.html").write_text(f"<html><body><nav>x</nav><h1>قانون الصحة العامة رقم (3) لسنة 2001</h1><article><p>{body}</p></article></body></html>", encoding="utf-8")
    pages = files.pages(spark, str(folder)).withColumn("source_url", F.lit("http://x"))
    tables = structure(pages, TAXONOMY)
    doc = tables["documents"].first()
    assert doc.doc_slug == "law-2001-3" and doc.doc_number == "3" and doc.issue_year == 2001 and doc.doc_type == "law"
    assert tables["sections"].filter("section_type = 'article'").count() == 1
    assert tables["document_topics"].filter("is_primary").first().topic_slug == "health-law"
    assert tables["validation_results"].filter("severity = 'error' and not passed").count() == 0
    assert tables["summaries"].first().article_count == 1 and tables["cleaning_log"].first().rules == 10
    t = files.parse_taxonomy("topics:\n  # c\n  - id: a\n    level: 1\n    parent: null\n    keywords_ar:\n      - x # y\n      - 'z'\n  - id: b\n    keywords_ar:\n      - w\n")
    assert t == [{"id": "a", "level": 1, "parent": None, "keywords_ar": ["x", "z"]}, {"id": "b", "keywords_ar": ["w"]}]
    assert files.taxonomy(spark, str(tmp_path / "none.yaml")) == []
    assert [r.name for r in files.missing(spark, str(tmp_path), ["law-2001-3", "other"]).collect()] == ["other"]


def test_stream_equals_batch(spark, tmp_path):
    src, out = tmp_path / "land", str(tmp_path / "table")
    src.mkdir()
    for i in range(3):
        (src / f"d{i}.txt").write_text(f"نص {i}", encoding="utf-8")
    for _ in range(2):
        ingest.start(ingest.arriving(spark, str(src)), out, str(tmp_path / "cp")).awaitTermination(120)
        (src / "d9.txt").write_text("جديد", encoding="utf-8")
    assert {r.doc_slug: r.text for r in ingest.current(spark, out).collect()} == {"d0": "نص 0", "d1": "نص 1", "d2": "نص 2", "d9": "جديد"}


def test_summaries(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"doc_slug": "law-1966-12", "issue_year": 1966, "has_legal_basis": true, "unknown": 1}', encoding="utf-8")
    r = files.summaries(spark, str(tmp_path)).first()
    assert r.doc_slug == "law-1966-12" and r.issue_year == 1966 and r.has_legal_basis and "unknown" not in r.asDict() and len(r.asDict()) == 26
