"""Gold dimensions: calendar, actor, repository.

Scale notes:
* ``dim_date`` is generated from the window parameters; the days-with-data side
  of its join is bounded by the window length, so it is broadcast only behind
  the window clip (:func:`..plans.joins.broadcast_calendar`).
* ``dim_actor`` / ``dim_repo`` grow with the data (millions of logins), so
  their joins carry no broadcast hint: AQE picks from runtime sizes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.actors import max_class
from ..functions.timefn import month_start, weekday_sun0
from ..plans.joins import broadcast_calendar
from ..schemas import FULL, REDUCED


def _d(x) -> _dt.date:
    return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(x)


def calendar(spark: SparkSession, lo, hi) -> DataFrame:
    """One row per day of ``[lo, hi]`` (generated, never read)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(_d(lo)), F.lit(_d(hi)), F.expr("INTERVAL 1 DAY"))).alias("date"))


def days_with_data(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_date").alias("date")).distinct()


def dim_date(spark: SparkSession, events: DataFrame, lo, hi, format_change,
             gap_lo=None, gap_hi=None) -> DataFrame:
    """Calendar with year/month/weekday, source-format regime, known-gap flag
    and ``has_data``. ``format_change`` is the first reduced-format day."""
    lo, hi = _d(lo), _d(hi)
    cal = calendar(spark, lo, hi)
    # Clipped here, so that the calendar's length bounds it whatever the caller passes.
    seen = (days_with_data(events.where(F.col("event_date").between(F.lit(lo), F.lit(hi))))
            .withColumn("_seen", F.lit(True)))
    d = F.col("date")
    gap = (d.between(F.lit(_d(gap_lo)), F.lit(_d(gap_hi)))
           if gap_lo is not None else F.lit(False))
    return (cal.join(broadcast_calendar(seen), "date", "left")
            .select(
                d,
                F.year(d).alias("year"),
                F.month(d).alias("month"),
                month_start(d).alias("month_start"),
                weekday_sun0(d).alias("weekday"),
                weekday_sun0(d).isin(0, 6).alias("is_weekend"),
                F.when(d < F.lit(_d(format_change)), F.lit(FULL)).otherwise(F.lit(REDUCED))
                 .alias("source_format"),
                gap.alias("is_known_gap"),
                F.col("_seen").isNotNull().alias("has_data")))


def dim_actor(events: DataFrame) -> DataFrame:
    """actor -> class, any-bot, events, distinct repos, first/last day, cohort.

    The events are first counted by actor, class and repo: that buffer has no text, so it is a
    hash aggregate, and only its few rows are sorted for the largest class."""
    cells = (events.groupBy("actor", "actor_class", "repo")
             .agg(F.bool_or("is_bot").alias("is_bot"),
                  F.count(F.lit(1)).alias("n"),
                  F.min("event_date").alias("first_day"),
                  F.max("event_date").alias("last_day")))
    return (cells.groupBy("actor")
            .agg(max_class(F.col("actor_class")).alias("actor_class"),
                 F.bool_or("is_bot").alias("is_bot"),
                 F.sum("n").alias("total_events"),
                 F.countDistinct("repo").alias("distinct_repos"),
                 F.min("first_day").alias("first_day"),
                 F.max("last_day").alias("last_day"))
            .withColumn("cohort_month", month_start(F.col("first_day"))))


def repo_latest_language(pr_events: DataFrame) -> DataFrame:
    """Last non-NULL language per repo (value on the latest date; ties broken
    by the larger language name so the answer is deterministic)."""
    return (pr_events.where(F.col("repo_language").isNotNull())
            .groupBy("repo")
            .agg(F.max_by("repo_language", F.struct("event_date", "repo_language"))
                 .alias("language")))


def dim_repo(events: DataFrame, pr_events: DataFrame) -> DataFrame:
    """repo -> owner, language, events, distinct actors, first/last day.

    Both sides are aggregated to one row per repo before the join. NULL repos
    are excluded (the dimension key is not null); the quality report counts them.
    """
    # The owner is a function of the repo name, so grouping by both is the
    # same grouping - and keeps the aggregate hash-based (no string buffer).
    agg = (events.where(F.col("repo").isNotNull())
           .groupBy("repo", F.col("repo_owner").alias("owner"))
           .agg(F.count(F.lit(1)).alias("total_events"),
                F.countDistinct("actor").alias("distinct_actors"),
                F.min("event_date").alias("first_day"),
                F.max("event_date").alias("last_day")))
    lang = repo_latest_language(pr_events)
    return (agg.join(lang, "repo", "left")
            .select("repo", "owner", "language",
                    F.col("language").isNotNull().alias("has_language"),
                    "total_events", "distinct_actors", "first_day", "last_day"))
