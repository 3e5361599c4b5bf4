"""Layer sinks: partitioned writes with read-back, exports, run log.

All writers replace only the partitions they touch (dynamic overwrite) and
verify by re-reading what they wrote; the write is the only action besides
the verification read.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import RUN_LOG
from ..session import shared_dir, shuffles_released

DEFAULT_CODEC = "zstd"
EXPORT_MAX_MB = 40


def write_partitioned(df: DataFrame, path: str, partition_col: str = "event_date",
                      compression: str = DEFAULT_CODEC, rebalance: bool = False) -> dict:
    """Write ``df`` partitioned by day, replacing only touched days.

    ``rebalance=True`` adds one shuffle on the partition column with AQE's
    rebalance (hot days are split to the advisory size, small ones merged) -
    worth it after a shuffle (silver), not for map-only bronze whose files per
    day already equal its input files per day.

    Returns ``{"written": n, "read_back": m, "days": k, "seconds": s}``; the
    written count comes from an observation on the write itself.
    """
    obs = Observation("write")
    out = df.hint("rebalance", partition_col) if rebalance else df
    # The touched days come from the write itself (bounded by days in the batch).
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.collect_set(F.col(partition_col)).alias("days"))
    t0 = time.monotonic()
    with shuffles_released(df.sparkSession):
        (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("compression", compression)
         .partitionBy(partition_col).parquet(path))
        secs = time.monotonic() - t0
        m = obs.get
        written, days = m.get("rows", 0), list(m.get("days") or [])
        # Read back only the partitions this write touched.
        back = (read_layer(df.sparkSession, path, df.schema).where(F.col(partition_col).isin(days)).count()) if days else 0
    return {"written": written, "read_back": back, "days": len(days), "seconds": round(secs, 3)}


def write_table(df: DataFrame, path: str, compression: str = DEFAULT_CODEC) -> None:
    """An unpartitioned table (a layer of one input, gold, an export); its shuffles go when it is written."""
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").option("compression", compression).parquet(path)


def stored(df: DataFrame, what: str = "stored") -> DataFrame:
    """The frame written once in the shared folder and read back: later plans know its size."""
    path = shared_dir(df.sparkSession, f"{what}-{uuid.uuid4().hex[:12]}")
    write_table(df, path)
    return read_layer(df.sparkSession, path, df.schema)


def read_layer(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Scan a Hive-partitioned layer; ``event_date`` is recovered from
    the directory names (as DATE) and prunes partitions on predicates."""
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_days(spark: SparkSession, path: str, days: Iterable, schema) -> DataFrame:
    """The rows of some days of a layer: only these days' folders are listed and read, however
    long the layer's history is. Days without a folder give no rows."""
    name = lambda d: "__HIVE_DEFAULT_PARTITION__" if d is None else str(d)
    folders = [f for f in (f"{path.rstrip('/')}/event_date={name(d)}" for d in days) if has_layer(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def has_layer(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at ``path`` (through Hadoop's file system API)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def per_day_counts(spark: SparkSession, path: str, days: Iterable | None = None, schema=None) -> DataFrame:
    df = read_layer(spark, path, schema)
    if days is not None:
        df = df.where(F.col("event_date").isin(list(days)))
    return df.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


def append_run_log(spark: SparkSession, records: DataFrame, log_path: str) -> None:
    """Append one record per processed day (a DataFrame, no driver loop)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields]
    records.select(*cols).write.mode("append").json(log_path)


def read_run_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Tolerant read of the run log (malformed lines are dropped)."""
    return spark.read.schema(RUN_LOG).option("mode", "DROPMALFORMED").json(log_path)


def log_records(per_day: DataFrame, layer: str, seconds: float = 0.0,
                bytes_in: DataFrame | None = None, bytes_out: DataFrame | None = None) -> DataFrame:
    """Run-log rows from a per-day count table ``(event_date, rows)`` and, where known,
    per-day sizes ``(event_date, bytes_in)`` and ``(event_date, bytes_out)``."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    out = per_day.select("event_date", F.lit(layer).alias("layer"), F.col("rows").cast("long").alias("rows"))
    for name, sizes in (("bytes_in", bytes_in), ("bytes_out", bytes_out)):
        if sizes is None:
            out = out.withColumn(name, F.lit(None).cast("long"))
        else:
            out = out.join(sizes.select("event_date", F.col(name).cast("long").alias(name)), "event_date", "left")
    return out.withColumn("seconds", F.lit(float(seconds))).withColumn("logged_at", F.lit(now).cast("timestamp"))


def export(df: DataFrame, path: str, compression: str = DEFAULT_CODEC) -> dict:
    """Write one aggregate as Parquet, re-read its row count and size.

    No ``coalesce(1)``: the aggregates are small, AQE already coalesces their
    final partitions, and a grain mistake must not funnel into one task.
    """
    write_table(df, path, compression)
    with shuffles_released(df.sparkSession):
        back = df.sparkSession.read.parquet(path)
        rows = back.count()
        size = (back.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
                .distinct().agg(F.sum("s")).first()[0]) if rows else 0
    return {"rows": rows, "bytes": int(size or 0)}


def export_all(spark: SparkSession, out: str, named: dict[str, DataFrame],
               max_mb: float = EXPORT_MAX_MB) -> DataFrame:
    """Export every named aggregate and flag any above ``max_mb``
    (a grain that is too fine). Returns one row per export."""
    from ..operators.reports import ordered_export
    rows = []
    for name, df in named.items():
        m = export(ordered_export(name, df), f"{out.rstrip('/')}/{name}")
        rows.append((name, m["rows"], m["bytes"], m["bytes"] > max_mb * 1024 * 1024))
    return spark.createDataFrame(rows, "name string, rows long, bytes long, over_limit boolean")


def read_exports(spark: SparkSession, out: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """A10: one-line sources for every export, registered as temp views."""
    res = {}
    for n in names:
        df = spark.read.parquet(f"{out.rstrip('/')}/{n}")
        df.createOrReplaceTempView(n)
        res[n] = df
    return res
