"""Registered queries: exports and dashboard-page reports."""

from __future__ import annotations

from ..operators import reports as R
from .oracle import q
from .pipeline import Lake
from .registry import register


def _activity(lake):
    return R.monthly_activity(lake.fact_pr_event())


def _latency(lake):
    return R.monthly_latency(lake.pr_lifecycle())


def _contrib(lake):
    return lake.contributor_month()


@register("monthly_activity", q("activity", "SELECT * FROM activity"), ops="D11")
def monthly_activity(spark, sf_dir):
    return _activity(Lake(spark, sf_dir))


@register("monthly_language", q("lang", "SELECT * FROM lang"), ops="D12 B16")
def monthly_language(spark, sf_dir):
    return R.monthly_language(Lake(spark, sf_dir).fact_pr_event())


@register("monthly_ai_agents", q("agents", "SELECT * FROM agents"), ops="D13 B16")
def monthly_ai_agents(spark, sf_dir):
    return R.monthly_ai_agents(Lake(spark, sf_dir).fact_pr_event())


@register("monthly_latency", q("latency", "SELECT * FROM latency"), ops="D14 B16")
def monthly_latency(spark, sf_dir):
    return _latency(Lake(spark, sf_dir))


@register("censoring_matrix", q("censor", "SELECT * FROM censor"), ops="D15")
def censoring_matrix(spark, sf_dir):
    return R.censoring_matrix(Lake(spark, sf_dir).pr_lifecycle())


@register("retention_curve", q("retention", "SELECT * FROM retention"), ops="D16 B16")
def retention_curve(spark, sf_dir):
    return R.retention_curve(_contrib(Lake(spark, sf_dir)))


@register("repo_balance", q("balance", "SELECT * FROM balance"), ops="D17 B16")
def repo_balance(spark, sf_dir):
    return R.repo_balance(_contrib(Lake(spark, sf_dir)))


@register("calendar_export", q("dim_date", """
    SELECT date, year, month, source_format, is_known_gap, has_data FROM dim_date"""), ops="D18 G1")
def calendar_export(spark, sf_dir):
    return R.calendar_export(Lake(spark, sf_dir).dim_date())


@register("class_totals", q("activity", """
    SELECT actor_class, CAST(sum(events) AS BIGINT) AS events FROM activity GROUP BY 1"""), ops="D19")
def class_totals(spark, sf_dir):
    return R.class_totals(_activity(Lake(spark, sf_dir)))


@register("grand_total", q("activity", """
    SELECT CAST(sum(events) AS BIGINT) AS events FROM activity"""), ops="D20")
def grand_total(spark, sf_dir):
    return R.grand_total(_activity(Lake(spark, sf_dir)))


@register("class_series", q("activity", "SELECT month, actor_class, events FROM activity"), ops="D21 G1")
def class_series(spark, sf_dir):
    return R.class_series(_activity(Lake(spark, sf_dir)))


@register("class_share", q("activity", """
    SELECT month, actor_class, events,
           round(CAST(events AS DOUBLE) / sum(events) OVER (PARTITION BY month), 6) AS share
    FROM activity"""), ops="D22")
def class_share(spark, sf_dir):
    return R.class_share(_activity(Lake(spark, sf_dir)))


@register("top_ai_agents", q("agents", """
    SELECT actor, CAST(sum(events) AS BIGINT) AS events, max(repos) AS repos
    FROM agents GROUP BY 1 ORDER BY events DESC, actor LIMIT 15"""), ops="D23 G2")
def top_ai_agents(spark, sf_dir):
    return R.top_ai_agents(R.monthly_ai_agents(Lake(spark, sf_dir).fact_pr_event()))


@register("language_automation", q("lang", """
    SELECT language, CAST(sum(events) AS BIGINT) AS events,
           CAST(sum(CASE WHEN actor_class <> 'human' THEN events ELSE 0 END) AS BIGINT) AS automated,
           floor((2000 * sum(CASE WHEN actor_class <> 'human' THEN events ELSE 0 END) + sum(events))
                 / (2 * sum(events))) / 10.0 AS pct_automated
    FROM lang GROUP BY 1 HAVING sum(events) >= 500
    ORDER BY events DESC, language LIMIT 20"""), ops="D24 G2")
def language_automation(spark, sf_dir):
    return R.language_automation(R.monthly_language(Lake(spark, sf_dir).fact_pr_event()))


@register("coverage_card", q("dim_date", """
    SELECT min(date) AS first_day, max(date) AS last_day, count(*) AS days,
           count(*) FILTER (WHERE source_format = 'full') AS full_days,
           count(*) FILTER (WHERE is_known_gap) AS gap_days,
           (SELECT count(DISTINCT event_date) FROM stg_events) AS days_with_data,
           (SELECT min(event_date) FROM stg_events) AS first_data_day, (SELECT max(event_date) FROM stg_events) AS last_data_day
    FROM dim_date"""), ops="D25")
def coverage_card(spark, sf_dir):
    return R.coverage_card(Lake(spark, sf_dir).dim_date())


@register("days_per_format", q("dim_date", """
    SELECT source_format, count(*) AS days FROM dim_date WHERE has_data GROUP BY 1"""), ops="D26")
def days_per_format(spark, sf_dir):
    return R.days_per_format(Lake(spark, sf_dir).dim_date())


@register("mean_of_medians", q("latency", """
    SELECT author_class, CAST(sum(prs) AS BIGINT) AS prs,
           floor((2 * sum(round(median_h_review * 100)) + count(median_h_review)) / (2 * count(median_h_review))) / 100.0 AS h_review, floor((2 * sum(round(median_h_merge * 100)) + count(median_h_merge)) / (2 * count(median_h_merge))) / 100.0 AS h_merge
    FROM latency WHERE mature_cohort GROUP BY 1"""), ops="D27")
def mean_of_medians(spark, sf_dir):
    return R.mean_of_medians(_latency(Lake(spark, sf_dir)))


@register("global_median", q("lifecycle", """
    SELECT author_class, count(*) AS prs,
           floor((round((median(hours_to_first_review * 60)) * 10) + 3) / 6) / 100.0 AS h_review, floor((round((median(hours_to_merge * 60)) * 10) + 3) / 6) / 100.0 AS h_merge
    FROM lifecycle WHERE opening_observed AND author_class IS NOT NULL AND mature_cohort
    GROUP BY 1"""), ops="D27")
def global_median(spark, sf_dir):
    return R.global_median(Lake(spark, sf_dir).pr_lifecycle())


@register("latency_series", q("latency", """
    SELECT opening_month, author_class, median_h_review, median_h_merge
    FROM latency WHERE mature_cohort"""), ops="D28")
def latency_series(spark, sf_dir):
    return R.latency_series(_latency(Lake(spark, sf_dir)))


@register("maturity_split", q("latency", """
    SELECT CASE WHEN mature_cohort THEN 'mature cohort' ELSE 'not yet mature' END AS state,
           CAST(sum(prs) AS BIGINT) AS prs
    FROM latency GROUP BY 1"""), ops="B21 D29")
def maturity_split(spark, sf_dir):
    return R.maturity_split(_latency(Lake(spark, sf_dir)))


@register("censoring_situation", q("censor", """
    SELECT month,
           CASE WHEN opening_observed AND merge_observed THEN 'full cycle'
                WHEN opening_observed AND NOT merge_observed THEN 'no merge observed'
                WHEN NOT opening_observed AND merge_observed THEN 'opened before window'
                ELSE 'intermediate events only' END AS situation,
           CAST(sum(prs) AS BIGINT) AS prs
    FROM censor GROUP BY 1, 2"""), ops="B20 D30")
def censoring_situation(spark, sf_dir):
    return R.censoring_situation(R.censoring_matrix(Lake(spark, sf_dir).pr_lifecycle()))


@register("retention_series", q("retention", """
    SELECT cohort_month, months_of_life, actors FROM retention"""), ops="D31")
def retention_series(spark, sf_dir):
    return R.retention_series(R.retention_curve(_contrib(Lake(spark, sf_dir))))


@register("top_repos", q("balance", """
    SELECT repo, CAST(sum(active_actors) AS BIGINT) AS accumulated_active,
           CAST(sum(new_actors) AS BIGINT) AS accumulated_new
    FROM balance GROUP BY 1 ORDER BY accumulated_active DESC, repo LIMIT 20"""), ops="D32 G2")
def top_repos(spark, sf_dir):
    return R.top_repos(R.repo_balance(_contrib(Lake(spark, sf_dir))))
