"""Raw-feed sources: hourly ndjson files, file inventory, storage sizes.

``scan_raw`` reads text only (no schema inference, no parsing) and stamps each
line with the date and hour of its *file*, taken from the path, so one job
can cover any number of days. Gzip is not splittable: one task per hourly
file, which is the natural unit of parallelism for this feed.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_released

# Archive layout ``.../2025-08-13-5.json.gz`` (hour not zero-padded) and the
# partitioned layout our writer produces ``.../file_date=2025-08-13/file_hour=5/...``.
ARCHIVE_RE = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json(\.gz)?$"
PARTITIONED_RE = r"file_date=(\d{4}-\d{2}-\d{2})/file_hour=(\d{1,2})/"


def _group(path: Column, regex: str, idx: int) -> Column:
    return F.nullif(F.regexp_extract(path, regex, idx), F.lit(""))


def path_date(path: Column) -> Column:
    return F.coalesce(_group(path, PARTITIONED_RE, 1), _group(path, ARCHIVE_RE, 1))


def path_hour(path: Column) -> Column:
    return F.coalesce(_group(path, PARTITIONED_RE, 2), _group(path, ARCHIVE_RE, 2)).cast("int")


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """``value, file_date, file_hour`` for every line under ``path``."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    p = F.col("_metadata.file_path")
    return raw.select("value", path_date(p).alias("file_date"), path_hour(p).alias("file_hour"))


def write_raw(feed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``value, file_date, file_hour`` lines as gzip text, one folder per
    hour (test fixtures and the incremental demo; the archive itself arrives
    as files). Lines are clustered by hour first (AQE rebalance: a hot hour is
    split into several files instead of one task), so an hour is one or a few
    files."""
    with shuffles_released(feed.sparkSession):
        (feed.hint("rebalance", "file_date", "file_hour")
         .write.mode(mode).option("compression", "gzip")
         .partitionBy("file_date", "file_hour").text(path))


def _listed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


def file_listing(spark: SparkSession, path: str, glob: str | None = None, empty: bool = False) -> DataFrame:
    """``path, length, modified`` of every file below ``path`` (compressed or not); the
    content column is never selected, so no file is read. Scans pass over files of no length;
    with ``empty`` they are taken from the driver's own listing (their names alone)."""
    files = _listed(spark, path, glob)
    out = files.select("path", F.col("length"), F.col("modificationTime").alias("modified"))
    if not empty:
        return out
    names = [(unquote(re.sub("^file:/+", "file:/", n)),) for n in files.inputFiles()]
    none = spark.createDataFrame(names, "path string").join(out, "path", "left_anti")
    return out.unionByName(none.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified")))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per source file: day, hour (NULL for an unrecognised name), bytes,
    modification time (NULL for an empty file), state ok or empty."""
    p = F.col("path")
    return file_listing(spark, path, empty=True).select(
        path_date(p).cast("date").alias("file_date"), path_hour(p).alias("file_hour"),
        F.col("length").alias("bytes"), "modified",
        F.when(F.col("length") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("state"), p)


def hour_states(spark: SparkSession, path: str, lo: str, hi: str) -> DataFrame:
    """Every hour of ``[lo, hi]`` with its state: ok, empty or absent."""
    from ..operators.planning import expected_hours
    have = (file_inventory(spark, path).groupBy("file_date", "file_hour")
            .agg(F.max("state").alias("state")))       # 'ok' sorts after 'empty'
    want = expected_hours(spark, lo, hi).select(F.col("day").alias("file_date"), F.col("hour").alias("file_hour"))
    return (want.join(have, ["file_date", "file_hour"], "left")
            .withColumn("state", F.coalesce("state", F.lit("absent"))))


#: Largest file whose content fits one value of a row.
CHECKSUM_MAX_BYTES = (1 << 31) - (1 << 20)


def file_checksums(spark: SparkSession, path: str, max_bytes: int = CHECKSUM_MAX_BYTES) -> DataFrame:
    """``path, bytes, sha256`` of each file, apart from the listing since it reads the
    content, one file a row. A file above ``max_bytes`` isn't read (the length filter reaches
    the scan) and has a NULL checksum, so it never stops the others."""
    some = F.col("length").between(1, max_bytes)
    read = _listed(spark, path).where(some).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    rest = file_listing(spark, path, empty=True).where(~some).select(
        "path", F.col("length").alias("bytes"), F.when(F.col("length") == 0, F.sha2(F.lit(b""), 256)).alias("sha256"))
    return read.unionByName(rest)


def file_volume(spark: SparkSession, path: str) -> DataFrame:
    """K1 by source file: ``path, file_date, file_hour, lines, text_bytes, compressed_bytes, ratio``
    (text bytes without line ends for a compressed byte). Files without lines are listed too."""
    p = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")     # as the listing spells it
    text = (spark.read.option("recursiveFileLookup", "true").text(path).groupBy(p.alias("path"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value")).alias("text_bytes")))
    files = file_inventory(spark, path).select("path", "file_date", "file_hour", F.col("bytes").alias("compressed_bytes"))
    out = files.join(text, "path", "left").fillna(0, ["lines", "text_bytes"])
    return out.withColumn("ratio", F.when(F.col("compressed_bytes") > 0, F.round(F.col("text_bytes") / F.col("compressed_bytes"), 4)))


def unrecognised(raw: DataFrame) -> DataFrame:
    """Lines whose file name gave no date: they belong to no day and must fail a job."""
    return raw.where(F.col("file_date").isNull())


def layer_bytes(spark: SparkSession, layer_path: str) -> DataFrame:
    """``event_date, bytes_out, files_out`` of a partitioned layer, from its file listing."""
    day = _group(F.col("path"), r"event_date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return (file_listing(spark, layer_path, "*.parquet").groupBy(day.alias("event_date"))
            .agg(F.sum("length").alias("bytes_out"), F.count(F.lit(1)).alias("files_out")))


def storage_report(spark: SparkSession, raw_path: str, layer_path: str) -> DataFrame:
    """Bytes in (raw files) vs bytes out (layer files) per day, and their ratio,
    from the two file listings alone."""
    bin_ = (file_inventory(spark, raw_path).groupBy(F.col("file_date").alias("event_date"))
            .agg(F.sum("bytes").alias("bytes_in"), F.count(F.lit(1)).alias("files_in"),
                 F.countDistinct("file_hour").alias("hours_in")))
    bout = layer_bytes(spark, layer_path)
    return (bin_.join(bout, "event_date", "full_outer")
            .withColumn("ratio", F.round(F.col("bytes_out") / F.col("bytes_in"), 4)))
