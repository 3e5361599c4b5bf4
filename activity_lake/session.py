"""Session construction and the settings that change answers.

Answer-relevant settings (applied by :func:`configure` on any session, including
one created by somebody else):

* ``spark.sql.session.timeZone = UTC`` - every daily / monthly bucket is a UTC
  bucket, and ISO-8601 ``Z`` text parses to the right instant.
* ``spark.sql.sources.partitionOverwriteMode = dynamic`` - overwriting a day must
  never delete sibling days.
* ``spark.sql.parquet.compression.codec = zstd`` - smaller layers than snappy.

Sizing settings (AQE, coalescing, skew join, partition sizes) are defaults for
sessions we build ourselves; on a cluster they come from the job submission.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ANSWER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # NULL-valued JSON fields are omitted when events are serialised, which is
    # what makes reduced-format rows lack the full-format keys.
    "spark.sql.jsonGenerator.ignoreNullFields": "true",
}

SIZING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Coalesce to the advisory size rather than to maximum parallelism: at
    # cluster scale this is what keeps post-shuffle partitions ~128 MB.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the answer-relevant settings to an existing session (idempotent)."""
    for k, v in ANSWER_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


#: Whether a query's shuffle files are removed when it ends, instead of when the driver's JVM
#: happens to collect its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """For writes of tables that are read back: no later query reads their shuffles, so their
    files go as soon as the table is written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def build_session(app: str = "activity_lake", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC, dynamic overwrite, zstd and AQE."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SIZING_CONF, **ANSWER_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names the shared (cluster-visible) folder. Only a
    single-machine session (``local[...]``) may lack it and gets a folder of its own;
    anywhere else a missing setting is an error, since executors would write to
    their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="activity-lake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
    return path
