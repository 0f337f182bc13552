"""What the operators of this package share: inputs, the shared folder, Arrow mapping."""

from __future__ import annotations

import os
import uuid
import zlib
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """df; batches between the engine and Python hold so many rows from now on, as texts are large."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text, null as empty, besides other columns that are asked for."""
    small_batches(docs)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def free_name(df: DataFrame, name: str) -> str:
    """name, or a longer one that no column of df has."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of what the plan reads or makes, 1 at least."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(1, int(str(size)))


def parts(df: DataFrame, each: int = 16 << 20, least: int = 8) -> int:
    """Number of partitions of about `each` bytes of compressed input; where its size isn't known, of the session's shuffles."""
    size = input_bytes(df)
    if size >= 1 << 60:  # what Catalyst takes for unknown
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return int(min(1_000_000, max(least, -(-size // each))))


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df in reliable storage; executors may be lost afterwards."""
    shared_root(spark)
    return df.checkpoint(eager=True)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is named, one under /tmp is set if the session has no other machines, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file:///tmp/sijill-shared"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_folder(spark: SparkSession, kind: str) -> str:
    """URI of a new folder in the shared storage."""
    uri = f"{shared_root(spark)}/{kind}-{uuid.uuid4().hex}"
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)
    return uri


def filesystem(uri: str):
    """Arrow file system and path of a URI; runs on the driver and on executors."""
    from pyarrow import fs

    u = urlparse(uri)
    if u.scheme in ("", "file"):
        return fs.LocalFileSystem(), u.path
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks) -> int:
    """Writes a file whole or not at all: a task that runs twice leaves the same file."""
    fs, path = filesystem(uri)
    part = f"{path}.{uuid.uuid4().hex}"
    n = 0
    with fs.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
            n += len(c)
    fs.move(part, path)
    return n


def read_file(uri: str):
    """Buffer over a file: mapped into memory where it is local, else read."""
    fs, path = filesystem(uri)
    if type(fs).__name__ == "LocalFileSystem" and os.path.getsize(path):
        import pyarrow as pa

        return pa.memory_map(path).read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, over an array, wrapping."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hash of each token (bytes) met, kept while the table is small."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        h = self[word] = xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_kept: dict = {}


def kept(kind, make=None):
    """What a Python worker keeps between tasks: one thing at a time, so that the operators of a pipeline don't add up. Without make, nothing."""
    if kind not in _kept:
        import ctypes

        import pyarrow as pa

        _kept.clear()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)  # else freed memory stays with the worker
        except (AttributeError, OSError):
            pass
        _kept[kind] = make() if make else None
    return _kept[kind]


def crc32(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
