"""Landed pages as a stream: cleaned as they arrive and upserted into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records
from ..sources.files import slug_of


def arriving(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    """A stream of landed texts: doc_slug, text, arrived."""
    df = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", files_at_once).text(path)
    return df.select(slug_of(F.col("_metadata.file_path")).alias("doc_slug"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("arrived"))


def without_repeats(stream: DataFrame, within: str = "1 day") -> DataFrame:
    """The first arrival of each document within a span of time."""
    return stream.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["doc_slug"])


def upsert_into(path: str):
    """A sink for foreachBatch: each batch makes a new generation of the table; the newest row of a document wins.

    A generation is a folder of its own, named by the batch, so a batch that runs again writes the
    same folder, and readers never see one half written.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = current(spark, path, before=number)
        rows = batch if old is None else records.upserted(old, batch, ["doc_slug"], "arrived").drop("gen")
        if old is None:
            rows = records.latest(batch, ["doc_slug"], "arrived")
        rows.write.mode("overwrite").parquet(f"{path}/generation={number:012d}")

    return sink


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The last whole generation of a table, null if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = sorted(n for n in names if n.startswith("generation=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))
                  and (before is None or int(n.split("=")[1]) < before))
    return spark.read.parquet(f"{path}/{done[-1]}") if done else None


def start(stream: DataFrame, path: str, checkpoint: str, **trigger):
    return stream.writeStream.foreachBatch(upsert_into(path)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
