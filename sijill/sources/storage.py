"""Reliable storage for what several tables are derived from."""

from __future__ import annotations

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """df in the shared folder that the session names in spark.checkpoint.dir; executors may be lost afterwards.

    Where no folder is named, one under /tmp is set if the session has no other machines, as in tests.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = "file:///tmp/sijill-shared"
        context.setCheckpointDir(folder)
    return df.checkpoint()
