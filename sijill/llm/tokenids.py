"""Token ids of whole texts in Simple-8b files, in ascending order of documents.

Texts are dealt by ranges of doc_id, each task encodes its range and writes one file into the
shared folder; a file appears whole under a name of its own, so a task that runs again leaves
the same file. The driver sees one row a file and adds up where each begins.

Null texts count as empty and hold the end id only; null doc_ids come first; rows of one
doc_id are ordered by a hash of their text; an empty table gives no files and no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simple8b
from .common import crc32, parts, read_file, shared_folder, texts, write_file
from .wordbpe import chunked, encoder

END_ID = 1
#: Words that a worker knows between batches.
KEEP = 1_000_000


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> list[tuple[int, str, int, int]]:
    """Writes the files; returns (number, uri, ids, ids before) of each, in order."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, doc_ids, lengths, ids = encoder(tokenizer, KEEP), [], [], []
        for batch in batches:
            some = batch.column(1).to_pylist()
            for a, b in chunked(some):
                flat, n = enc.encode(some[a:b], end_id)
                lengths += n.tolist()
                ids.append(flat)
            doc_ids += batch.column(0).to_pylist()
        if not doc_ids:
            return
        number = TaskContext.get().partitionId()
        flat = np.concatenate(ids)
        ids.clear()
        uri = f"{folder}/{number:08d}.s8b"
        write_file(uri, simple8b.encode_file(doc_ids, lengths, flat))
        yield pa.RecordBatch.from_pydict({"number": [number], "uri": [uri], "ids": [len(flat)]},
                                         schema=pa.schema([("number", pa.int64()), ("uri", pa.string()), ("ids", pa.int64())]))

    source = texts(docs)
    tie = F.xxhash64("text")
    rows = (source.repartitionByRange(parts(docs), F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
            .mapInArrow(run, "number long, uri string, ids long").collect())  # one row a file
    out, before = [], 0
    for r in sorted(rows):
        out.append((r.number, r.uri, r.ids, before))
        before += r.ids
    return out


def read(spark, files: list[tuple[int, str, int, int]]) -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = simple8b.Reader(read_file(uri))
                starts = np.cumsum(f.lengths) - f.lengths
                crcs = [crc32(f.ids(s, n).tobytes()) for s, n in zip(starts.tolist(), f.lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64()), pa.array(starts + before, pa.int64()), pa.array(f.lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame([(uri, before) for _, uri, _, before in files], "uri string, before long")
    return rows.repartition(max(1, len(files))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, tokenizer, shared_folder(spark, "token-ids")))
