"""What the vector searches share: valid vectors, shards, blocks of queries, and the merge.

Vectors go into shards by a hash, queries into blocks; each pair of a shard and a block is one
group of bounded size, and each gives the best few rows for each of its queries.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries treated together.
BLOCK = 1024


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of distinct rows that are whole: no null, NaN or infinity, one component at least, and an id."""
    x = F.col("vector")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & (F.size(x) > 0)
                    & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
            .dropDuplicates(["vec_id", "vector"]))


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def blocks_of(queries: DataFrame, shards: int, n_queries: int) -> tuple[DataFrame, int]:
    """(shard, block, query_id, vector): each query once for each shard, and the number of blocks."""
    blocks = max(1, -(-n_queries // BLOCK))
    return queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                          F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int").alias("block"),
                          F.col("vec_id").alias("query_id"), "vector"), blocks


def over_blocks(df: DataFrame, blocks: int) -> DataFrame:
    return df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def best(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """Ranks 1 to k for each query over the results of all shards."""
    w = Window.partitionBy("query_id").orderBy(*order, F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def matrix(column) -> np.ndarray:
    """Vectors of one length, as rows."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def by_length(table) -> dict[int, object]:
    """Rows of a table by the length of their vectors."""
    import pyarrow.compute as pc

    if not table.num_rows:
        return {}
    n = pc.list_value_length(table.column("vector"))
    return {k: table.filter(pc.equal(n, k)) for k in pc.unique(n).to_pylist()}
