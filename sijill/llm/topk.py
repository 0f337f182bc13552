"""Exact top-k inner products by Fagin's threshold algorithm.

Each shard holds, for each dimension, its rows in the order of that component. A query goes
down the lists side by side, from the top where its own component is positive and from the
bottom where it is negative, some rows at a time; rows met for the first time get their full
score. No row that isn't met yet can score more than the query times the components at which
the lists stand, and once that bound is below the k-th score the search stops. Where it can't
stop before the lists have met half of a shard, the other half is met at once.

Components are turned into floor(scale * x). Scores are exact as long as they fit 53 bits, else
they are added up as 64-bit integers. Queries only meet vectors of their own length. Equal rows
count once; rows that share the query's vec_id are its own. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import blocks_of, by_length, best, matrix, over_blocks, shard_of, valid

SCALE, EVERY, K = 256, 50, 5
SHARD, STEP = 8192, 32


class Lists:
    """A shard's rows and its sorted list of each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        bound = float(np.abs(rows).max(initial=0)) ** 2 * rows.shape[1]
        self.exact = bound < 2**53
        self.floats = rows.astype(np.float64) if self.exact else None

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact and float(np.abs(q).max(initial=0)) * float(np.abs(self.rows).max(initial=0)) * len(q) < 2**53:
            return (self.floats[at] @ q.astype(np.float64)).astype(np.int64)
        return self.rows[at] @ q

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best rows but the query's own; ties to the smaller id."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        down = q[dims] > 0
        met = self.ids == query_id
        best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        while depth < n:
            upto = min(n, max(STEP, 2 * depth))
            fresh = np.zeros(n, bool)
            if len(dims) and 2 * np.count_nonzero(met) < n:
                fresh[self.order[n - upto : n - depth, dims[down]].ravel()] = True
                fresh[self.order[depth:upto, dims[~down]].ravel()] = True
            else:  # the lists would meet little else than what is met, or all scores are equal
                fresh[:], upto = True, n
            fresh &= ~met
            met |= fresh
            at = np.flatnonzero(fresh)
            ids, scores = np.concatenate([best_ids, self.ids[at]]), np.concatenate([best_scores, self.scores(at, q)])
            keep = np.lexsort([ids, -scores])[:k]
            best_ids, best_scores = ids[keep], scores[keep]
            depth = upto
            if depth < n and len(best_ids) == k:
                stand = np.where(down, self.sorted[n - 1 - depth, dims], self.sorted[depth, dims])
                if int(stand @ q[dims]) < best_scores[-1]:
                    break
        return list(zip(best_ids.tolist(), best_scores.tolist(), strict=True))


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row whose vec_id is divisible by `every`."""
    rows = valid(vectors)
    whole = rows.select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("vector"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards = max(1, -(-n.n // shard_rows))
    queries, blocks = blocks_of(whole.filter(F.col("vec_id") % every == 0), shards, n.q)
    sharded = over_blocks(whole.withColumn("shard", shard_of(F.col("vec_id"), shards)), blocks)

    def run(stored, asked):
        import pyarrow as pa

        out, asked = [], by_length(asked)
        for length, some in by_length(stored).items():
            if length not in asked:
                continue
            lists = Lists(some.column("vec_id").to_numpy(), matrix(some.column("vector")))
            for query_id, q in zip(asked[length].column("query_id").to_pylist(), matrix(asked[length].column("vector")), strict=True):
                out += [(query_id, i, s) for i, s in lists.top(query_id, q, k)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    found = (sharded.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
             .applyInArrow(run, "query_id long, vec_id long, score long"))
    return best(found, k, F.desc("score"))
