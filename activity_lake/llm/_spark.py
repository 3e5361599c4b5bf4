"""Small Spark helpers of the subpackage: scratch tables in the shared folder, workers' memory."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the folder that the session names in spark.checkpoint.dir."""
    return shared_dir(spark, f"{what}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, what: str) -> DataFrame:
    """The frame written once as Parquet in the shared folder and read back: cuts the
    lineage, survives lost executors, and every later use sees the same rows."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str):
    """A column of text (of any type) as UTF-8 bytes."""
    return F.col(column).cast("string").cast("binary")


def release() -> None:
    """Gives the free memory of this process back to the system: workers are reused, and would
    hold what one stage freed through all later ones, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's own
    if trim:
        trim(0)


def tidy(run):
    """A mapInArrow function whose worker holds no free memory before it begins and after it ends."""
    def tidied(batches):
        release()
        yield from run(batches)
        release()

    return tidied
