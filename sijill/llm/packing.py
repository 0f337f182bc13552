"""Packing of documents into sequences of a fixed length: bounded-space online best fit.

Each partition keeps a fixed number of open windows. What is left of a document after its full
sequences goes where it fits best. If it fits nowhere and no more windows may be opened, the
fullest is topped up with a piece of it and emitted, and the rest takes its place. Windows that
are still open at the end are merged in groups of a few neighbouring partitions, cut so that at
most the last sequence of a group is not full.

Null and empty texts hold the end id only. Repeated rows are packed each for itself; an empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc32, texts
from .wordbpe import chunked, encoder

LENGTH, OPEN, END_ID = 4096, 16, 2
CHUNK = 1_000_000  # characters encoded together; it bounds memory only
#: Partitions whose open windows are merged in one task: at most GROUP * OPEN * LENGTH ids.
GROUP = 4
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Packer:
    """Open windows; a window is [free, [(doc_id, start, ids, doc_tokens), ...]]."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most, self.windows, self.done = length, most, [], []

    def put(self, window: list, piece: tuple) -> None:
        window[1].append(piece)
        window[0] -= len(piece[2]) // 4
        if not window[0]:
            self.windows.remove(window)
            self.done.append(window[1])

    def add(self, doc_id, ids: bytes) -> None:
        total, at, size = len(ids) // 4, 0, self.length
        while total - at >= size:
            self.done.append([(doc_id, at, ids[4 * at : 4 * (at + size)], total)])
            at += size
        while at < total:
            rest = total - at
            fits = [w for w in self.windows if w[0] >= rest]
            if fits:
                self.put(min(fits, key=lambda w: w[0]), (doc_id, at, ids[4 * at :], total))
                return
            if len(self.windows) < self.most:
                self.windows.append([size, []])
                self.put(self.windows[-1], (doc_id, at, ids[4 * at :], total))
                return
            fullest = min(self.windows, key=lambda w: w[0])
            n = fullest[0]
            self.put(fullest, (doc_id, at, ids[4 * at : 4 * (at + n)], total))
            at += n


def rows_of(sequences, sequence_id: int, keep: bool = False):
    """A row for each piece; with its ids if they are needed again."""
    for pieces in sequences:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc_id, start, n, crc32(ids), total, sequence_id, offset, ids if keep else None
            offset += n
        sequence_id += 1


def merged(pieces: list[tuple], length: int = LENGTH) -> list[list[tuple]]:
    """Pieces one after the other, cut where a sequence is full."""
    out, free = [], 0
    for doc_id, start, ids, total in pieces:
        while ids:
            if not free:
                out.append([])
                free = length
            part, ids = ids[: 4 * free], ids[4 * free :]
            n = len(part) // 4
            out[-1].append((doc_id, start, part, total))
            start, free = start + n, free - n
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """One row a piece: where its ids stand in its document and in its sequence."""
    schema = f"{PIECE}, ids binary, part long"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, enc, packer, first = TaskContext.get().partitionId(), encoder(tokenizer), Packer(length, most), 0
        kinds = pa.schema([*((n, pa.int64()) for n in NAMES), ("ids", pa.binary()), ("part", pa.int64())])

        def made(sequences, number, keep=False):
            rows = list(rows_of(sequences, (part << 32) + number, keep))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip([*columns, [part] * len(rows)], kinds, strict=True)], schema=kinds)

        for batch in batches:
            doc_ids, some = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunked(some, CHUNK):
                flat, n = enc.encode(some[a:b], end_id)
                raw, ends = flat.tobytes(), (4 * np.cumsum(n)).tolist()
                for doc_id, x, y in zip(doc_ids[a:b], [0, *ends], ends):
                    packer.add(doc_id, raw[x:y])
                yield made(packer.done, first)
                first += len(packer.done)
                packer.done = []
        yield made([w[1] for w in packer.windows], first, keep=True)

    def merge(key, left):
        import pandas as pd

        left = left.sort_values(["sequence_id", "offset"])
        pieces = list(zip(left.doc_id.astype(object).where(left.doc_id.notna(), None), left.start, left.ids, left.doc_tokens, strict=True))
        rows = [r[:7] for r in rows_of(merged(pieces, length), (1 << 62) + (int(key[0]) << 32))]
        out = pd.DataFrame(rows, columns=NAMES)
        return out.astype({n: "int64" for n in NAMES if n != "doc_id"} | {"doc_id": "Int64"})

    packed = checkpointed(docs.sparkSession, texts(docs).mapInArrow(run, schema))  # both parts below read it
    full = packed.filter(F.col("ids").isNull()).select(*NAMES)
    left = packed.filter(F.col("ids").isNotNull())
    return full.unionByName(left.groupBy((F.col("part") / GROUP).cast("long").alias("part_group")).applyInPandas(merge, PIECE))
