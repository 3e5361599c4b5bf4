"""Registered queries: gold dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims
from .joins import broadcast_calendar
from .oracle import q
from .output import for_output
from .pipeline import Lake
from .registry import register


@register("dim_date", q("dim_date", "SELECT * FROM dim_date"), ops="B18 C1 D4 D5")
def dim_date(spark, sf_dir):
    return Lake(spark, sf_dir).dim_date()


@register("dim_actor", q("dim_actor", "SELECT * FROM dim_actor"), ops="D1")
def dim_actor(spark, sf_dir):
    return Lake(spark, sf_dir).dim_actor()


@register("repo_latest_language", q("lang_latest", "SELECT * FROM lang_latest"), ops="D2")
def repo_latest_language(spark, sf_dir):
    return dims.repo_latest_language(Lake(spark, sf_dir).stg_pr_events())


@register("dim_repo", q("dim_repo", "SELECT * FROM dim_repo"), ops="C2 D3")
def dim_repo(spark, sf_dir):
    return Lake(spark, sf_dir).dim_repo()


@register("fact_pr_event", q("fact", "SELECT * FROM fact"), ops="B17")
def fact_pr_event(spark, sf_dir):
    return for_output(Lake(spark, sf_dir).fact_pr_event())


@register("pr_lifecycle", q("lifecycle", "SELECT * FROM lifecycle"), ops="B19 D6 D7 D8")
def pr_lifecycle(spark, sf_dir):
    return for_output(Lake(spark, sf_dir).pr_lifecycle())


@register("pr_latency", q("lifecycle", """
    SELECT opening_cohort, mature_cohort,
           count(*) AS prs,
           count(hours_to_first_review) AS with_review,
           count(hours_to_merge) AS with_merge,
           round(sum(hours_to_merge), 6) AS sum_h_merge,
           count(*) FILTER (WHERE hours_to_merge IS NOT NULL
               AND round(hours_to_merge * 60, 6) <> floor(date_diff('second', opened_ts, merged_ts) / 60)) AS boundary_differs
    FROM lifecycle WHERE opening_observed GROUP BY 1, 2"""), ops="D7 D8")
def pr_latency(spark, sf_dir):
    """Latency summary per opening cohort, including how many merge latencies
    differ between boundary-counted minutes and elapsed minutes."""
    lc = Lake(spark, sf_dir).pr_lifecycle().where(F.col("opening_observed"))
    elapsed_min = F.floor((F.unix_timestamp("merged_ts") - F.unix_timestamp("opened_ts")) / 60)
    m = F.col("hours_to_merge")
    return (lc.groupBy("opening_cohort", "mature_cohort")
            .agg(F.count(F.lit(1)).alias("prs"),
                 F.count("hours_to_first_review").alias("with_review"),
                 F.count(m).alias("with_merge"),
                 F.round(F.sum(m), 6).alias("sum_h_merge"),
                 F.count_if(m.isNotNull() & (F.round(m * 60, 6) != elapsed_min)).alias("boundary_differs")))


@register("contributor_month", q("contrib", "SELECT * FROM contrib"), ops="D9 D10 C3 B22")
def contributor_month(spark, sf_dir):
    return Lake(spark, sf_dir).contributor_month()


@register("contributor_cohort", q("contrib", """
    SELECT cohort_month, months_of_life, is_first_month, count(*) AS pairs, sum(events) AS events
    FROM contrib GROUP BY 1, 2, 3"""), ops="C3 D10 B22")
def contributor_cohort(spark, sf_dir):
    return (Lake(spark, sf_dir).contributor_month()
            .groupBy("cohort_month", "months_of_life", "is_first_month")
            .agg(F.count(F.lit(1)).alias("pairs"), F.sum("events").alias("events")))


@register("star_join", q(("fact", "dim_date", "lang_latest"), """
    SELECT d.year, d.source_format, a.actor_class AS actor_dim_class, r.has_language,
           count(*) AS events, count(DISTINCT f.pr_id) AS prs
    FROM fact f
    JOIN dim_date d ON d.date = f.date
    JOIN (SELECT actor, max(actor_class) AS actor_class FROM stg_events GROUP BY actor) a ON a.actor = f.actor
    JOIN (SELECT e.repo, l.language IS NOT NULL AS has_language
          FROM (SELECT DISTINCT repo FROM stg_events WHERE repo IS NOT NULL) e
          LEFT JOIN lang_latest l ON l.repo = e.repo) r ON r.repo = f.repo
    GROUP BY 1, 2, 3, 4"""), ops="C9")
def star_join(spark, sf_dir):
    """Fact enriched through the star: date (broadcast, bounded by the
    window), actor and repo dimensions (grow with data: planner's choice)."""
    lake = Lake(spark, sf_dir)
    f = lake.fact_pr_event()
    d = broadcast_calendar(lake.dim_date().select("date", "year", "source_format"))
    a = lake.dim_actor().select("actor", F.col("actor_class").alias("actor_dim_class"))
    r = lake.dim_repo().select("repo", "has_language")
    return (f.join(d, "date").join(a, "actor").join(r, "repo")
            .groupBy("year", "source_format", "actor_dim_class", "has_language")
            .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("pr_id").alias("prs")))
