"""Layer-to-layer jobs: raw files -> bronze -> silver -> gold -> exports.

One job covers any number of days (no per-day driver loop). Every write
replaces only the partitions it touches and is verified by reading back.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import bronze as B
from ..operators import reports as R
from ..operators import silver as S
from ..schemas import BRONZE, EVENTS, PR_EVENTS, RETAINED_TYPES
from ..session import configure
from ..sources import raw as RAW
from ..sources import sinks as SK
from .pipeline import Lake


def bronze_job(spark: SparkSession, raw_path: str, bronze_path: str,
               retained_types=RETAINED_TYPES) -> dict:
    """Map-only: text scan -> envelope -> payload retention -> partitioned write."""
    configure(spark)
    files = RAW.file_inventory(spark, raw_path)
    strange = files.where(F.col("file_date").isNull() & (F.col("bytes") > 0)).count()
    if strange:
        raise RuntimeError(f"{strange} files have names without a date and hour; their rows belong to no day")
    br = B.retain_payload(B.to_bronze(RAW.scan_raw(spark, raw_path)), retained_types)
    return _verified(SK.write_partitioned(br, bronze_path))


def _verified(result: dict) -> dict:
    """The write's row count, or an error if reading back gives another one."""
    if result["written"] != result["read_back"]:
        raise RuntimeError(f"read-back mismatch: {result}")
    return result


def silver_job(spark: SparkSession, bronze_path: str, silver_root: str,
               lo: str | None = None, hi: str | None = None) -> dict:
    """Two tables, partition-pruned input; a shuffle each for the dedup and one for the
    rebalance of the write."""
    configure(spark)
    bronze = S.stage(SK.read_layer(spark, bronze_path, BRONZE), lo, hi)
    ev = _verified(SK.write_partitioned(S.to_events(bronze), f"{silver_root}/events", rebalance=True))
    pr = _verified(SK.write_partitioned(S.to_pr_events(bronze), f"{silver_root}/pr_events", rebalance=True))
    return {"events": ev, "pr_events": pr}


def gold_lake(spark: SparkSession, silver_root: str, **params) -> Lake:
    """A :class:`Lake` whose silver comes from the written layer."""
    return Lake(spark, None, events=SK.read_layer(spark, f"{silver_root}/events", EVENTS),
                pr_events=SK.read_layer(spark, f"{silver_root}/pr_events", PR_EVENTS), **params)


def gold_job(spark: SparkSession, silver_root: str, gold_root: str, **params) -> dict:
    """Materialise the three dimensions and three facts."""
    lake = gold_lake(spark, silver_root, **params)
    tables = {"dim_date": lake.dim_date(), "dim_actor": lake.dim_actor(), "dim_repo": lake.dim_repo(),
              "fact_pr_event": lake.fact_pr_event(), "fact_pr_lifecycle": lake.pr_lifecycle(),
              "fact_contributor_month": lake.contributor_month()}
    out = {}
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{gold_root}/{name}")
        out[name] = spark.read.parquet(f"{gold_root}/{name}").count()
    return out


def export_job(spark: SparkSession, gold_root: str, export_root: str):
    """The eight exported aggregates, from the materialised gold tables."""
    g = {n: spark.read.parquet(f"{gold_root}/{n}") for n in
         ("dim_date", "fact_pr_event", "fact_pr_lifecycle", "fact_contributor_month")}
    named = {
        "monthly_activity": R.monthly_activity(g["fact_pr_event"]),
        "monthly_language": R.monthly_language(g["fact_pr_event"]),
        "monthly_ai_agents": R.monthly_ai_agents(g["fact_pr_event"]),
        "monthly_latency": R.monthly_latency(g["fact_pr_lifecycle"]),
        "censoring_matrix": R.censoring_matrix(g["fact_pr_lifecycle"]),
        "retention_curve": R.retention_curve(g["fact_contributor_month"]),
        "repo_balance": R.repo_balance(g["fact_contributor_month"]),
        "calendar_export": R.calendar_export(g["dim_date"]),
    }
    return SK.export_all(spark, export_root, named)
