"""Gold facts: PR event, PR lifecycle, contributor month.

Scale notes:
* ``pr_lifecycle`` is one aggregate keyed by ``(repo, pr_id)`` with map-side
  partial aggregation; every measure is a min/max/count, so a hot PR costs one
  partial row per input partition, not its event count. (It is sort-based:
  the opener struct and the language carry strings; the format is reduced to
  a boolean and the class to an integer rank elsewhere for the same reason.)
* The review count needs no DISTINCT: silver is unique on
  ``(event_id, event_date)`` (E1, checked by J1/J10), so counting review rows
  *is* the distinct count of review keys - no Expand, no second shuffle.
* ``contributor_month`` pre-aggregates to ``(month, repo, actor)`` first; the
  cohort is then a window ``min`` over ``(repo, actor)`` on that small result
  (at most one row per month per pair), which replaces the reference's
  self-join and its extra shuffle of the fact.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.actors import max_class
from ..functions.timefn import boundary_hours, month_start, months_between_starts

REVIEW = "PullRequestReviewEvent"


def fact_pr_event(pr_events: DataFrame) -> DataFrame:
    """Event-grain PR fact (pure projection)."""
    return pr_events.select(
        F.col("event_date").alias("date"), "event_id", "created_ts", "event_type",
        "action", "is_merge", "payload_format", "actor", "actor_class", "is_bot",
        "repo", "repo_language", "pr_id", "pr_number", "lines_added",
        "lines_deleted", "review_state")


def maturity_cutoff(window_hi, maturity_days: int = 30) -> str:
    hi = window_hi if isinstance(window_hi, _dt.date) else _dt.date.fromisoformat(window_hi)
    return f"{hi - _dt.timedelta(days=maturity_days)} 00:00:00"


def pr_lifecycle(pr_events: DataFrame, window_hi, maturity_days: int = 30) -> DataFrame:
    """One row per ``(repo, pr_id)`` with censoring flags and latencies.

    ``pr_events`` must already be clipped to the window (staging), since the
    censoring flags are relative to it. Rows are never filtered by the flags.
    """
    ts, et, act = F.col("created_ts"), F.col("event_type"), F.col("action")
    opened = act == F.lit("opened")
    # The author is whoever opened the PR (earliest opener; event id breaks ties).
    opener = F.min(F.when(opened, F.struct(ts.alias("t"), F.col("event_id").alias("i"),
                                           F.col("actor").alias("a"),
                                           F.col("actor_class").alias("c"))))
    # The number first: the sort compares eight bytes of its first key before whole rows, and
    # the names of many repos share theirs.
    agg = (pr_events.groupBy("pr_id", "repo")
           .agg(F.min(F.when(opened, ts)).alias("opened_ts"),
                F.min(F.when(et == F.lit(REVIEW), ts)).alias("first_review_ts"),
                F.min(F.when(F.col("is_merge"), ts)).alias("merged_ts"),
                F.max(F.when((act == F.lit("closed")) & ~F.col("is_merge"), ts)).alias("closed_unmerged_ts"),
                opener.alias("_opener"),
                F.max("repo_language").alias("language"),
                # max('full', 'reduced') = 'reduced' iff any reduced event
                F.bool_or(F.col("payload_format") == F.lit("reduced")).alias("_any_reduced"),
                F.count(F.lit(1)).alias("pr_events"),
                F.count(F.when(et == F.lit(REVIEW), F.lit(1))).alias("reviews"),
                F.min("event_date").alias("first_date"),
                F.max("event_date").alias("last_date")))
    o, r, m = F.col("opened_ts"), F.col("first_review_ts"), F.col("merged_ts")
    cutoff = F.lit(maturity_cutoff(window_hi, maturity_days)).cast("timestamp")
    return agg.select(
        "repo", "pr_id",
        F.col("_opener.a").alias("author"),
        F.col("_opener.c").alias("author_class"),
        "language",
        F.when(F.col("_any_reduced"), F.lit("reduced"))
         .when(~F.col("_any_reduced"), F.lit("full")).alias("payload_format"),
        "opened_ts", "first_review_ts", "merged_ts",
        "closed_unmerged_ts", "reviews", "pr_events", "first_date", "last_date",
        month_start(F.to_date(o)).alias("opening_cohort"),
        o.isNotNull().alias("opening_observed"),
        m.isNotNull().alias("merge_observed"),
        (o.isNotNull() & (o <= cutoff)).alias("mature_cohort"),
        F.when(o.isNotNull() & r.isNotNull() & (r >= o), boundary_hours(o, r)).alias("hours_to_first_review"),
        F.when(o.isNotNull() & m.isNotNull() & (m >= o), boundary_hours(o, m)).alias("hours_to_merge"),
    )


def contributor_month(events: DataFrame) -> DataFrame:
    """``(month, repo, actor)`` activity with the per-repo cohort.

    NULL repos / actors are dropped up front: the cohort relation is an inner
    equi-join on both keys in the model, which never matches NULL.
    """
    # Counted by class and type first: that buffer has no text, so it is a hash aggregate.
    cells = (events.where(F.col("repo").isNotNull() & F.col("actor").isNotNull())
             .groupBy(month_start(F.col("event_date")).alias("month"), "repo", "actor", "actor_class", "event_type")
             .agg(F.bool_or("is_bot").alias("is_bot"),
                  F.count(F.lit(1)).alias("n"),
                  # A month has at most 31 days: a bitmap counts them without a second DISTINCT.
                  F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth("event_date"))).alias("_days")))
    # One shuffle by (repo, actor) serves the rows of a month and the cohort's window; so does
    # one sort, as the month comes last in the key.
    monthly = (cells.repartition("repo", "actor").groupBy("actor", "repo", "month")
               .agg(max_class(F.col("actor_class")).alias("actor_class"),
                    F.bool_or("is_bot").alias("is_bot"),
                    F.sum("n").alias("events"),
                    F.bit_or("_days").alias("_days"),
                    F.countDistinct("event_type").alias("distinct_types")))
    w = Window.partitionBy("actor", "repo")
    return (monthly.select("month", "repo", "actor", "actor_class", "is_bot", "events",
                           F.bit_count("_days").cast("long").alias("active_days"), "distinct_types")
            .withColumn("cohort_month", F.min("month").over(w))
            .withColumn("months_of_life", months_between_starts(F.col("cohort_month"), F.col("month")))
            .withColumn("is_first_month", F.col("month") == F.col("cohort_month")))
