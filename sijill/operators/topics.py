"""Topics by keywords, by vectors, and by decisions from elsewhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions import values as v

IN_TITLE, IN_OPENING, IN_BODY = 40, 20, 5  # hundredths
OPENING, THRESHOLD = 800, 40
MOST_KEYWORDS = 100_000


def keyword_literal(taxonomy: list[dict], most: int = MOST_KEYWORDS) -> list[dict]:
    """Taxonomy entries in their order, checked to be few enough to stand in a plan."""
    if sum(len(t.get("keywords_ar") or ()) for t in taxonomy) > most:
        raise ValueError("too many keywords for literals in a plan")
    return [t for t in taxonomy if t.get("keywords_ar")]


def scores(docs: DataFrame, taxonomy: list[dict], key: str = "doc_id", title: str = "title_ar", body: str = "normalized_text", least: int = THRESHOLD, normal: bool = False) -> DataFrame:
    """key, topic_slug, topic_name_ar, topic_ord, confidence, matched_keywords: topics of at least 40 points.

    The taxonomy stands in the plan as literals, folded keywords included, so documents are neither
    shuffled nor multiplied by keywords: a topic's points are one generated sum, and only topics that
    reach the threshold become rows, which then get their matches. Bodies that text.normalize has made
    are `normal`: for these most of its work isn't done again.
    """
    entries = keyword_literal(taxonomy)
    if not entries:
        return docs.select(key, F.lit(0).alias("topic_ord"), F.lit("").alias("topic_slug"), F.lit("").alias("topic_name_ar"), F.lit(0.0).alias("confidence"), F.array(F.lit("")).alias("matched_keywords")).filter("false")
    plain = folded(docs.sparkSession, sorted({k for t in entries for k in t["keywords_ar"]}))
    df = docs.select(key, text.normalize(F.coalesce(F.col(title), F.lit(""))).alias("_t"), text.normalize(F.substring(F.col(body), 1, OPENING)).alias("_o"), (text.normalize_again if normal else text.normalize)(F.col(body)).alias("_b"))
    words = F.array(*[F.array(*[F.struct(F.lit(k).alias("w"), F.lit(plain[k]).alias("p")) for k in t["keywords_ar"]]) for t in entries])
    facts = F.array(*[F.struct(F.lit(i).alias("topic_ord"), F.lit(t["id"]).alias("topic_slug"), F.lit(t.get("name_ar") or "").alias("topic_name_ar")) for i, t in enumerate(entries)])

    def points(words: list[str]) -> Column:
        """A topic's points; bodies are gone through only where the title and the opening leave the threshold within reach, else nothing is scored."""
        def total(in_body: bool) -> Column:
            one = lambda k: F.when(F.contains("_t", k), IN_TITLE).when(F.contains("_o", k), IN_OPENING)
            return reduce(Column.__add__, [(one(k).when(F.contains("_b", k), IN_BODY) if in_body else one(k)).otherwise(0) for k in (F.lit(plain[w]) for w in words)])
        return F.when(total(False) >= least - IN_BODY * len(words), total(True)).otherwise(0)

    scored = F.array(*[F.struct(F.lit(i).alias("at"), points(t["keywords_ar"]).alias("points")) for i, t in enumerate(entries)])
    found = df.select(key, "_b", F.explode(F.filter(scored, lambda s: s["points"] >= least)).alias("s")).select(key, "_b", "s.*")
    matched = F.transform(F.filter(F.get(words, "at"), lambda x: F.contains("_b", x["p"])), lambda x: x["w"])
    found = found.select(key, F.get(facts, "at").alias("fact"), (F.least(F.lit(100), "points") / 100).alias("confidence"), matched.alias("matched_keywords"))
    return found.select(key, "fact.*", "confidence", "matched_keywords")


def folded(spark, words: list[str]) -> dict[str, str]:
    """Keywords as they stand in normalised texts; the driver works them out from a local table."""
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.normalize(F.col("w")).alias("p")).collect()
    return {r.w: r.p for r in rows}


def ranked(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Topics with rank and is_primary; ties in the taxonomy's order."""
    w = Window.partitionBy(key).orderBy(F.desc("confidence"), "topic_ord")
    return found.withColumn("rank", F.row_number().over(w)).withColumn("is_primary", F.col("rank") == 1)


def primary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return ranked(found, key).filter("is_primary").drop("rank", "is_primary")


def with_model(found: DataFrame, model: DataFrame, key: str = "doc_id", below: float = 0.5) -> DataFrame:
    """Ranked topics where a model's topic (key, topic_slug, topic_name_ar, confidence) comes first if the keywords' best is weak and worse."""
    keyword = ranked(found, key).drop("rank", "topic_ord").withColumn("extraction_method", F.lit("keyword"))
    own = [c for c in keyword.columns if c != key]
    types = {f.name: f.dataType for f in keyword.schema}
    offered = {"topic_slug": F.col("topic_slug"), "topic_name_ar": F.col("topic_name_ar"), "confidence": F.col("confidence"), "is_primary": F.lit(True), "extraction_method": F.lit("model")}
    # a row a document on either side, so that the keywords' topics are worked out once
    mine = keyword.groupBy(key).agg(F.collect_list(F.struct(*own)).alias("mine"), F.max("confidence").alias("best"))
    offers = model.groupBy(key).agg(F.collect_list(F.struct(*[offered.get(c, F.lit(None)).cast(types[c]).alias(c) for c in own])).alias("offers"))
    best, none = F.coalesce("best", F.lit(0.0)), lambda c: F.coalesce(c, F.slice(F.coalesce("mine", "offers"), F.lit(1), F.lit(0)))
    both = mine.join(offers, key, "full_outer").select(key, none("mine").alias("mine"), F.filter(none("offers"), lambda m: (best < below) & (m["confidence"] > best)).alias("better"))

    def second(m):
        kept = F.filter("mine", lambda t: m["topic_slug"].isNull() | (m["topic_slug"] != t["topic_slug"]))
        return F.transform(kept, lambda t: t.withField("is_primary", t["is_primary"] & m["topic_slug"].isNull()))

    rest = F.when(F.size("better") == 0, F.col("mine")).otherwise(F.flatten(F.transform("better", second)))
    return both.select(key, F.explode(F.concat("better", rest)).alias("t")).select(key, *[f"t.{c}" for c in ("topic_slug", "topic_name_ar", "confidence", "is_primary", "extraction_method") if c in own],
                                                                                   *[f"t.{c}" for c in own if c not in offered])


def assignments(found: DataFrame, slug: str = "doc_slug") -> DataFrame:
    """Assignment records of ranked topics."""
    doc, topic = ids.doc_id(F.col(slug)), ids.topic_id(F.col("topic_slug"))
    return found.select(slug, ids.assignment_id(doc, topic).alias("assignment_id"), doc.alias("doc_id"), topic.alias("topic_id"), "topic_slug", "topic_name_ar",
                        "is_primary", "confidence", F.lit("keyword").alias("extraction_method"), "matched_keywords")


def distribution(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents by primary topic; (none) for those without."""
    return (docs.select(key).join(primary(found, key).select(key, "topic_slug"), key, "left")
            .groupBy(F.coalesce("topic_slug", F.lit("(none)")).alias("topic")).agg(F.count(F.lit(1)).alias("n")))


def retopic(docs: DataFrame, clean: DataFrame, taxonomy: list[dict]) -> dict[str, DataFrame]:
    """Topics of stored documents (doc_slug, title_ar) anew from their clean texts (doc_slug, normalized_text): assignments, coverage in one row, distribution by primary topic.

    Documents without a clean text are left out; the coverage of no documents is 0.
    """
    both = docs.select("doc_slug", "title_ar").join(clean.select("doc_slug", "normalized_text"), "doc_slug")
    found = ranked(scores(both, taxonomy, "doc_slug"), "doc_slug")
    covered = both.select("doc_slug").join(found.select("doc_slug").distinct().withColumn("hit", F.lit(1)), "doc_slug", "left")
    coverage = covered.agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("covered"))
    coverage = coverage.withColumn("coverage_pct", F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("covered"), F.col("total")), 1), F.lit(0.0)))
    return {"assignments": assignments(found), "coverage": coverage, "distribution": distribution(both, found, "doc_slug")}


def nearest_label(vectors: DataFrame, labels: DataFrame, most: int = 10_000) -> DataFrame:
    """vec_id, label, similarity: the label vector (label, embedding) of greatest cosine; ties to the smaller label.

    Labels stand in the plan after their number is checked.
    """
    rows = labels.select("label", F.transform("embedding", lambda x: x.cast("double")).alias("e")).orderBy("label").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("more labels than may stand in a plan")
    table = F.array(*[F.struct(F.lit(r.label).alias("label"), F.array(*[F.lit(x) for x in r.e]).alias("e")) for r in rows])
    x = F.transform("embedding", lambda a: a.cast("double"))

    def cosine(e: Column) -> Column:
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, y: s + y)
        return dot(x, e) / F.sqrt(dot(x, x) * dot(e, e))

    best = F.array_max(F.transform(table, lambda t: F.struct(cosine(t["e"]).alias("similarity"), (-t["label"]).alias("m"))))
    return vectors.select("vec_id", best.alias("b")).select("vec_id", (-F.col("b.m")).alias("label"), F.col("b.similarity").alias("similarity"))


def parsed_decision(response: Column) -> Column:
    """topic_id, confidence, reasoning of a model's answer; null if it holds no such object or names no topic."""
    body = F.regexp_extract(F.regexp_replace(response, "```(?:json)?", ""), r"(?s)\{.*\}", 0)
    parsed = F.from_json(body, "topic_id string, confidence string, reasoning string")
    named = F.regexp_replace(parsed["topic_id"], "^topic-", "")
    return F.when(named != "", F.struct(named.alias("topic_id"), F.coalesce(parsed["confidence"].try_cast("double"), F.lit(0.0)).alias("confidence"), parsed["reasoning"].alias("reasoning")))


def enhanced(found: DataFrame, decisions: DataFrame, key: str = "doc_id", below: float = 0.8, least: float = 0.9, topics=tuple(v.DECISION_TOPICS)) -> DataFrame:
    """Primary topics of documents whose best is weak, replaced by decisions (key, topic_id, confidence) that are sure and known; the originals stay beside."""
    new = (decisions.select(F.col(key).alias("new_key"), F.col("topic_id").alias("new_topic"), F.col("confidence").alias("new_confidence"))
           .filter((F.col("new_confidence") >= least) & F.col("new_topic").isin(*topics)))
    best = found.withColumn("best", F.max("confidence").over(Window.partitionBy(key)))
    out, hit = best.join(new, (F.col(key) == F.col("new_key")) & (F.col("best") < below), "left").drop("best", "new_key"), F.col("is_primary") & F.col("new_topic").isNotNull()
    return (out.withColumn("original_topic", F.when(hit, F.col("topic_slug"))).withColumn("original_confidence", F.when(hit, F.col("confidence")))
            .withColumn("topic_slug", F.when(hit, F.col("new_topic")).otherwise(F.col("topic_slug")))
            .withColumn("confidence", F.when(hit, F.col("new_confidence")).otherwise(F.col("confidence"))).drop("new_topic", "new_confidence"))
