"""The queries of this package, one opN_<name> for each operator, with production parameters."""

from __future__ import annotations

from . import bpe, hnsw, lm, ordermin, packing, repeats, secrets, tokenids, topk, toxicity
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_lm(spark, sf_dir):
    return lm.fit_and_score(table(spark, sf_dir, "documents"))


def op3_tokenids(spark, sf_dir):
    return tokenids.encode_and_read(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op4_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_hnsw(spark, sf_dir):
    return hnsw.search(table(spark, sf_dir, "embeddings"))


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_repeats(spark, sf_dir):
    return repeats.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed")


def op9_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_ordermin(spark, sf_dir):
    return ordermin.classes(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_secrets, op2_lm, op3_tokenids, op4_bpe, op5_hnsw, op6_packing, op7_topk, op8_repeats, op9_toxicity, op10_ordermin)}


TOP_K_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can say the same; the other operators are tested against brute force."""
    return {"op7_topk": TOP_K_SQL}
