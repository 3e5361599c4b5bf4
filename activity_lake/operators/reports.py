"""Exported aggregates and the dashboard-page queries over them.

Exports (D11-D18) read the facts; page queries (D19-D32) read the exports,
which are 2-3 orders of magnitude smaller than the facts. Every top-k carries a
key tie-break so the answer is deterministic.

Scale notes:
* Distinct counts over few groups (month x class) use Spark's distinct
  rewrite: the first aggregate is keyed by (group, distinct value), so a hot
  group is spread over many tasks and pre-aggregated map-side.
* Exact medians/percentiles use ``percentile``, whose buffer is a *value ->
  count* map that merges partially; latencies have minute resolution, so a
  group's buffer is bounded by the window length in minutes, not by rows.
* Where a fact grain already guarantees uniqueness (one row per
  ``(month, repo, actor)``), ``count(distinct actor)`` per ``(repo, month)`` is
  a plain count - no Expand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.actors import AI_AGENT, HUMAN
from ..functions.timefn import hours_2dp_from_minutes, mean_2dp, month_start, pct_1dp


# ------------------------------------------------------------------ exports
#: Sketches have 2**SKETCH_LG registers: a relative standard error of 1.04 / 2**(SKETCH_LG / 2).
SKETCH_LG = 14


def _sketch(column: str) -> F.Column:
    return F.hll_sketch_agg(column, F.lit(SKETCH_LG)).alias(f"{column}_sketch")


def _estimate(column: str) -> F.Column:
    """Distinct values from the union of stored sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(f"{column}_sketch", F.lit(False)))


def daily_sketches(fact: DataFrame) -> DataFrame:
    """D11 as a mergeable layer: ``date, actor_class, events`` and a sketch of fixed size of the
    repos and of the actors. A day is sketched once; any longer span is a union of days, so a month
    needs neither its events nor a DISTINCT over them."""
    return fact.groupBy("date", "actor_class").agg(F.count(F.lit(1)).alias("events"), _sketch("repo"), _sketch("actor"))


def monthly_activity_estimate(daily: DataFrame) -> DataFrame:
    """D11 from ``daily_sketches``: exact events, estimated distinct repos and actors."""
    return (daily.groupBy(month_start(F.col("date")).alias("month"), "actor_class")
            .agg(F.sum("events").alias("events"), _estimate("repo").alias("repos"), _estimate("actor").alias("actors")))


def retention_sketches(contrib: DataFrame) -> DataFrame:
    """D16 as a mergeable layer: one row a month and cohort month with sketches of the humans' actors and
    repos. A new month adds its own rows and touches no older ones."""
    return contrib.where(F.col("actor_class") == HUMAN).groupBy("month", "cohort_month", "months_of_life").agg(
        _sketch("actor"), _sketch("repo"))


def retention_estimate(sketches: DataFrame) -> DataFrame:
    """D16 from ``retention_sketches``."""
    return (sketches.groupBy("cohort_month", "months_of_life")
            .agg(_estimate("actor").alias("actors"), _estimate("repo").alias("repos")))


def monthly_activity(fact: DataFrame) -> DataFrame:
    """Month x class -> events, distinct repos, distinct actors."""
    return (fact.groupBy(month_start(F.col("date")).alias("month"), "actor_class")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.countDistinct("repo").alias("repos"),
                 F.countDistinct("actor").alias("actors")))


def monthly_language(fact: DataFrame, min_events: int = 50) -> DataFrame:
    """Month x language x class -> events, kept when >= ``min_events``."""
    return (fact.where(F.col("repo_language").isNotNull())
            .groupBy(month_start(F.col("date")).alias("month"),
                     F.col("repo_language").alias("language"), "actor_class")
            .agg(F.count(F.lit(1)).alias("events"))
            .where(F.col("events") >= min_events))


def monthly_ai_agents(fact: DataFrame) -> DataFrame:
    """AI-agent activity per login and month."""
    return (fact.where(F.col("actor_class") == F.lit(AI_AGENT))
            .groupBy(month_start(F.col("date")).alias("month"), "actor")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.countDistinct("repo").alias("repos")))


def monthly_latency(lifecycle: DataFrame) -> DataFrame:
    """Opening month x author class x maturity -> counts and medians."""
    r, m = F.col("hours_to_first_review"), F.col("hours_to_merge")
    return (lifecycle.where(F.col("opening_observed") & F.col("author_class").isNotNull())
            .groupBy(month_start(F.to_date("opened_ts")).alias("opening_month"),
                     "author_class", "mature_cohort")
            .agg(F.count(F.lit(1)).alias("prs"),
                 F.count(r).alias("with_review"),
                 F.count(m).alias("with_merge"),
                 hours_2dp_from_minutes(F.median(r * 60)).alias("median_h_review"),
                 hours_2dp_from_minutes(F.median(m * 60)).alias("median_h_merge"),
                 hours_2dp_from_minutes(F.percentile(m * 60, F.lit(0.9))).alias("p90_h_merge")))


def censoring_matrix(lifecycle: DataFrame) -> DataFrame:
    """First-seen month x opening observed x merge observed -> PRs."""
    return (lifecycle.groupBy(month_start(F.col("first_date")).alias("month"),
                              "opening_observed", "merge_observed")
            .agg(F.count(F.lit(1)).alias("prs")))


def retention_curve(contrib: DataFrame) -> DataFrame:
    """Cohort month x month of life -> distinct actors / repos (non-bots)."""
    return (contrib.where(~F.col("is_bot"))
            .groupBy("cohort_month", "months_of_life")
            .agg(F.countDistinct("actor").alias("actors"),
                 F.countDistinct("repo").alias("repos")))


def repo_balance(contrib: DataFrame, min_active: int = 5) -> DataFrame:
    """Repo x month -> new and active non-bot contributors (active >= N).

    The fact has one row per (month, repo, actor), so per (repo, month) the
    distinct-actor counts are row counts.
    """
    return (contrib.where(~F.col("is_bot"))
            .groupBy("repo", "month")
            .agg(F.count(F.when(F.col("is_first_month"), F.lit(1))).alias("new_actors"),
                 F.count(F.lit(1)).alias("active_actors"))
            .where(F.col("active_actors") >= min_active))


def calendar_export(dim_date: DataFrame) -> DataFrame:
    """D18."""
    return dim_date.select("date", "year", "month", "source_format", "is_known_gap", "has_data")


# G1: the sort order each export is written in (asc, or mixed asc/desc);
# plain (column, descending) pairs so importing needs no Spark session.
EXPORT_ORDER = {
    "monthly_activity": [("month", False), ("actor_class", False)],
    "monthly_language": [("month", False), ("events", True), ("language", False), ("actor_class", False)],
    "monthly_ai_agents": [("month", False), ("events", True), ("actor", False)],
    "monthly_latency": [("opening_month", False), ("author_class", False), ("mature_cohort", False)],
    "censoring_matrix": [("month", False), ("opening_observed", False), ("merge_observed", False)],
    "retention_curve": [("cohort_month", False), ("months_of_life", False)],
    "repo_balance": [("month", False), ("active_actors", True), ("repo", False)],
    "calendar_export": [("date", False)],
}


def ordered_export(name: str, df: DataFrame) -> DataFrame:
    """G1: an export in its published order (range-partitioned sort; the
    exports are small aggregates, and AQE coalesces the sorted partitions)."""
    keys = EXPORT_ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.desc(c) if d else F.asc(c) for c, d in keys])


# --------------------------------------------------------------- page queries
def class_totals(activity: DataFrame) -> DataFrame:
    """D19."""
    return activity.groupBy("actor_class").agg(F.sum("events").alias("events"))


def grand_total(activity: DataFrame) -> DataFrame:
    """D20."""
    return activity.agg(F.sum("events").alias("events"))


def class_series(activity: DataFrame) -> DataFrame:
    """D21."""
    return activity.select("month", "actor_class", "events")


def class_share(activity: DataFrame) -> DataFrame:
    """Share of the month's events per class (100% stacked series)."""
    w = Window.partitionBy("month")
    return activity.select(
        "month", "actor_class", "events",
        F.round(F.col("events").cast("double") / F.sum("events").over(w), 6).alias("share"))


def top_ai_agents(agents: DataFrame, k: int = 15) -> DataFrame:
    """Events summed, repos = *max* monthly distinct repos."""
    return (agents.groupBy("actor")
            .agg(F.sum("events").alias("events"), F.max("repos").alias("repos"))
            .orderBy(F.desc("events"), F.asc("actor")).limit(k))


def language_automation(lang: DataFrame, min_events: int = 500, k: int = 20) -> DataFrame:
    """Automated share per language, rounded percent, top k."""
    auto = F.sum(F.when(F.col("actor_class") != F.lit(HUMAN), F.col("events")).otherwise(F.lit(0)))
    return (lang.groupBy("language")
            .agg(F.sum("events").alias("events"), auto.alias("automated"))
            .where(F.col("events") >= min_events)
            .withColumn("pct_automated", pct_1dp(F.col("automated"), F.col("events")))
            .orderBy(F.desc("events"), F.asc("language")).limit(k))


def coverage_card(dim_date: DataFrame) -> DataFrame:
    """The calendar's range and regimes, and how many of its days have data."""
    return dim_date.agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("source_format") == F.lit("full")).alias("full_days"),
        F.count_if(F.col("is_known_gap")).alias("gap_days"),
        F.count_if("has_data").alias("days_with_data"),
        F.min(F.when(F.col("has_data"), F.col("date"))).alias("first_data_day"),
        F.max(F.when(F.col("has_data"), F.col("date"))).alias("last_data_day"))


def days_per_format(dim_date: DataFrame) -> DataFrame:
    """D26."""
    return (dim_date.where(F.col("has_data")).groupBy("source_format")
            .agg(F.count(F.lit(1)).alias("days")))


def mean_of_medians(latency: DataFrame) -> DataFrame:
    """The page's mean of monthly medians (not a global median)."""
    return (latency.where(F.col("mature_cohort")).groupBy("author_class")
            .agg(F.sum("prs").alias("prs"),
                 mean_2dp(F.col("median_h_review")).alias("h_review"),
                 mean_2dp(F.col("median_h_merge")).alias("h_merge")))


def global_median(lifecycle: DataFrame) -> DataFrame:
    """D27 (named companion): the true median over all mature PRs per class."""
    return (lifecycle.where(F.col("opening_observed") & F.col("author_class").isNotNull()
                            & F.col("mature_cohort"))
            .groupBy("author_class")
            .agg(F.count(F.lit(1)).alias("prs"),
                 hours_2dp_from_minutes(F.median(F.col("hours_to_first_review") * 60)).alias("h_review"),
                 hours_2dp_from_minutes(F.median(F.col("hours_to_merge") * 60)).alias("h_merge")))


def latency_series(latency: DataFrame) -> DataFrame:
    """D28."""
    return (latency.where(F.col("mature_cohort"))
            .select("opening_month", "author_class", "median_h_review", "median_h_merge"))


def maturity_label(mature) -> F.Column:
    """B21."""
    return F.when(mature, F.lit("mature cohort")).otherwise(F.lit("not yet mature"))


def maturity_split(latency: DataFrame) -> DataFrame:
    """D29."""
    return (latency.groupBy(maturity_label(F.col("mature_cohort")).alias("state"))
            .agg(F.sum("prs").alias("prs")))


def censoring_label(opened, merged) -> F.Column:
    """Four-way situation of a PR inside the window."""
    return (F.when(opened & merged, F.lit("full cycle"))
            .when(opened & ~merged, F.lit("no merge observed"))
            .when(~opened & merged, F.lit("opened before window"))
            .otherwise(F.lit("intermediate events only")))


def censoring_situation(matrix: DataFrame) -> DataFrame:
    """D30."""
    return (matrix.groupBy("month", censoring_label(F.col("opening_observed"),
                                                    F.col("merge_observed")).alias("situation"))
            .agg(F.sum("prs").alias("prs")))


def retention_series(curve: DataFrame) -> DataFrame:
    """D31."""
    return curve.select("cohort_month", "months_of_life", "actors")


def top_repos(balance: DataFrame, k: int = 20) -> DataFrame:
    """Repos by accumulated monthly active contributors."""
    return (balance.groupBy("repo")
            .agg(F.sum("active_actors").alias("accumulated_active"),
                 F.sum("new_actors").alias("accumulated_new"))
            .orderBy(F.desc("accumulated_active"), F.asc("repo")).limit(k))
