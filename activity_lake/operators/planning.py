"""Run planning: which days still need work, which hours are missing.

Everything is generated from parameters with ``sequence`` (one generator, no
cross join) and compared with anti/semi joins. The generated sides are bounded
by the window (days, or days x 24 hours), so they can be broadcast behind that
parameter check; the data side is first reduced to its distinct keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_calendar


def _d(x) -> _dt.date:
    return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))


def wanted_days(spark: SparkSession, lo, hi) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(_d(lo)), F.lit(_d(hi)), F.expr("INTERVAL 1 DAY"))).alias("day"))


def pending_days(spark: SparkSession, lo, hi, done: DataFrame | None = None,
                 gaps: list[tuple[str, str]] | None = None,
                 available: DataFrame | None = None) -> DataFrame:
    """Wanted days minus known gaps minus done days, restricted to days
    whose upstream input exists. ``done`` / ``available`` carry a ``day`` column."""
    days = wanted_days(spark, lo, hi)
    for g_lo, g_hi in gaps or []:
        days = days.where(~F.col("day").between(F.lit(_d(g_lo)), F.lit(_d(g_hi))))
    # Clipping to the window first is what proves the broadcast bound.
    in_window = F.col("day").between(F.lit(_d(lo)), F.lit(_d(hi)))
    if done is not None:
        d = done.select("day").where(in_window).distinct()
        days = days.join(broadcast_calendar(d), "day", "left_anti")
    if available is not None:
        a = available.select("day").where(in_window).distinct()
        days = days.join(broadcast_calendar(a), "day", "left_semi")
    return days


def expected_hours(spark: SparkSession, lo, hi) -> DataFrame:
    """Every ``(day, hour)`` of ``[lo, hi]`` from one hourly ``sequence``."""
    start = _dt.datetime.combine(_d(lo), _dt.time())
    end = _dt.datetime.combine(_d(hi), _dt.time(23))
    ts = F.explode(F.sequence(F.expr(f"TIMESTAMP_NTZ'{start}'"), F.expr(f"TIMESTAMP_NTZ'{end}'"),
                              F.expr("INTERVAL 1 HOUR"))).alias("t")
    return (spark.range(1).select(ts)
            .select(F.to_date("t").alias("day"), F.hour("t").alias("hour")))


def missing_hours(spark: SparkSession, lo, hi, inventory: DataFrame) -> DataFrame:
    """Expected hours with no source file. ``inventory`` has ``day, hour``."""
    present = (inventory.select("day", "hour")
               .where(F.col("day").between(F.lit(_d(lo)), F.lit(_d(hi)))).distinct())
    return expected_hours(spark, lo, hi).join(broadcast_calendar(present), ["day", "hour"], "left_anti")
