"""Registered queries: bronze and silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bronze as B
from ..operators import silver as S
from ..operators.quality import day_overlap, day_pairs, key_counts
from ..schemas import ENVELOPE, PR_TYPES, RETAINED_TYPES
from . import adapters as A
from .oracle import q
from .output import for_output
from .pipeline import Lake
from .registry import register

_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"


@register("raw_scan_envelope", q("P", f"""
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type,
           {_ISO.format(c='created_ts')} AS created_at, actor AS actor_login, repo AS repo_name,
           CAST(created_ts AS DATE) AS event_date
    FROM p_rows"""), ops="A1 A2 B1 B2")
def raw_scan_envelope(spark, sf_dir):
    """Envelope columns of every raw line (duplicates included, no dedup)."""
    return Lake(spark, sf_dir).pr_bronze().drop("event_json")


_RET_TYPES = ", ".join(f"'{t}'" for t in RETAINED_TYPES)


@register("payload_retention", q("E", f"""
    SELECT type, count(*) AS rows, count(*) FILTER (WHERE type IN ({_RET_TYPES})) AS retained
    FROM (SELECT event_type AS type FROM e_src
          UNION ALL SELECT 'PullRequestEvent' FROM orders WHERE o_orderkey % 11 <> 0
          UNION ALL SELECT 'PullRequestEvent' FROM orders WHERE o_orderstatus IN ('F', 'P')
          UNION ALL SELECT 'PullRequestReviewEvent' FROM lineitem
          UNION ALL SELECT 'PushEvent' FROM orders
          UNION ALL SELECT NULL FROM region) t
    GROUP BY type"""), ops="B3")
def payload_retention(spark, sf_dir):
    """Rows per type and how many keep their JSON text (no row is dropped)."""
    br = B.retain_payload(B.to_bronze(A.profile_feed(spark, sf_dir)), RETAINED_TYPES)
    return (br.groupBy("type")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count("event_json").alias("retained")))


@register("events_typed", q("E", """
    SELECT event_id, event_type, created_ts, actor, repo, repo_owner, event_date, is_bot, actor_class
    FROM e_events"""), ops="B4 B6 B9 B10 B11 E1")
def events_typed(spark, sf_dir):
    return for_output(Lake(spark, sf_dir).stream_events())


@register("pr_events_typed", q("P", """SELECT * FROM pr_events"""),
          ops="B5 B6 B7 B12 B13 B14 B15 E1")
def pr_events_typed(spark, sf_dir):
    return for_output(Lake(spark, sf_dir).pr_events())


@register("actor_class", q("P", """
    SELECT actor_class, is_bot, count(*) AS events, count(DISTINCT actor) AS actors
    FROM p_events GROUP BY 1, 2"""), ops="B10 B11")
def actor_class(spark, sf_dir):
    return (Lake(spark, sf_dir).events()
            .groupBy("actor_class", "is_bot")
            .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("actor").alias("actors")))


@register("partition_range", q("P", """
    SELECT event_date, count(*) AS events, count(DISTINCT event_type) AS types
    FROM p_events WHERE event_date BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'
    GROUP BY event_date"""), ops="A5 A7 B8")
def partition_range(spark, sf_dir):
    ev = S.stage(Lake(spark, sf_dir).events_by_day(), "1996-03-01", "1996-05-31")
    return (ev.groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_type").alias("types")))


_IN_DAYS = ["1995-06-01", "1997-01-15", "1999-01-01", "2001-07-31"]


@register("partition_in_list", q("P", f"""
    SELECT event_date, event_type, count(*) AS events
    FROM p_events WHERE event_date IN ({", ".join(f"DATE '{d}'" for d in _IN_DAYS)})
    GROUP BY 1, 2"""), ops="B8")
def partition_in_list(spark, sf_dir):
    ev = S.partition_in(Lake(spark, sf_dir).events_by_day(), _IN_DAYS)
    return ev.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("events"))


@register("dedup_by_day", q("E", """
    SELECT event_date, count(*) AS raw_rows, count(DISTINCT event_id) AS kept_rows
    FROM e_all GROUP BY event_date"""), ops="E1")
def dedup_by_day(spark, sf_dir):
    """Per day: raw rows vs rows kept by the ``(event_id, event_date)`` dedup."""
    lake = Lake(spark, sf_dir)
    raw = S.to_events(lake.event_bronze_stored(), dedup=False).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("raw_rows"))
    kept = lake.stream_events().groupBy("event_date").agg(F.count(F.lit(1)).alias("kept_rows"))
    return raw.join(kept, "event_date", "full_outer").fillna(0)


@register("dedup_naive_loss", q("P", """
    SELECT (SELECT count(*) FROM p_all) AS raw_rows,
           (SELECT count(*) FROM (SELECT DISTINCT event_id, event_date FROM p_all)) AS kept_by_day,
           (SELECT count(DISTINCT event_id) FROM p_all) AS kept_by_id_only,
           (SELECT count(*) FROM (SELECT DISTINCT event_id, event_date FROM p_all))
             - (SELECT count(DISTINCT event_id) FROM p_all) AS real_events_lost"""), ops="E1")
def dedup_naive_loss(spark, sf_dir):
    """How many real events a dedup on the bare id would erase."""
    ev = S.to_events(Lake(spark, sf_dir).pr_bronze_stored(), dedup=False)
    return (key_counts(ev).withColumnsRenamed({"n": "raw_rows", "pairs": "kept_by_day", "ids": "kept_by_id_only"})
            .withColumn("real_events_lost", F.col("kept_by_day") - F.col("kept_by_id_only")))


@register("duplicate_profile", q("E", """
    SELECT event_id, count(*) AS copies, count(DISTINCT event_type || '|' || CAST(created_ts AS VARCHAR)) AS variants,
           count(DISTINCT event_type || '|' || CAST(created_ts AS VARCHAR)) = 1 AS identical
    FROM e_typed GROUP BY event_id HAVING count(*) > 1"""), ops="E2")
def duplicate_profile(spark, sf_dir):
    """Ids seen more than once, copies, and whether the copies are identical
    (content compared by a 64-bit hash of the raw line)."""
    br = B.to_bronze(Lake(spark, sf_dir).event_raw())   # before payload retention
    return (br.select(F.expr("try_cast(id AS BIGINT)").alias("event_id"),
                      F.xxhash64("event_json").alias("h"))
            .groupBy("event_id")
            .agg(F.count(F.lit(1)).alias("copies"), F.countDistinct("h").alias("variants"))
            .where(F.col("copies") > 1)
            .withColumn("identical", F.col("variants") == 1))


@register("id_reuse", q("E", """
    SELECT event_id, count(DISTINCT event_date) AS dates, count(DISTINCT event_type) AS types,
           min(event_date) AS first_date, max(event_date) AS last_date
    FROM e_events GROUP BY event_id HAVING count(DISTINCT event_date) > 1"""), ops="C8 H1")
def id_reuse(spark, sf_dir):
    """Ids that name events on more than one date (informative, J1 companion)."""
    ev = Lake(spark, sf_dir).stream_events()
    return (ev.groupBy("event_id")
            .agg(F.countDistinct("event_date").alias("dates"),
                 F.countDistinct("event_type").alias("types"),
                 F.min("event_date").alias("first_date"),
                 F.max("event_date").alias("last_date"))
            .where(F.col("dates") > 1))


@register("id_day_collisions", q("P", """
    SELECT f.first_date AS day_first, e.event_date AS day_reused, count(*) AS shared_ids
    FROM (SELECT event_id, min(event_date) AS first_date FROM p_events GROUP BY event_id
          HAVING count(DISTINCT event_date) > 1) f
    JOIN (SELECT DISTINCT event_id, event_date FROM p_events) e
      ON e.event_id = f.event_id AND e.event_date > f.first_date
    GROUP BY 1, 2"""), ops="C8 H3")
def id_day_collisions(spark, sf_dir):
    """Day collisions of reused ids: for each id seen on several dates, its
    first date is paired with each later date (linear in rows - never all
    pairs of dates of an id), then counted per (first day, reuse day)."""
    ev = Lake(spark, sf_dir).events().select("event_id", "event_date")
    first = (ev.groupBy("event_id")
             .agg(F.min("event_date").alias("day_first"),
                  F.countDistinct("event_date").alias("n"))
             .where(F.col("n") > 1).drop("n"))
    return (ev.join(first, "event_id")
            .where(F.col("event_date") > F.col("day_first"))
            .groupBy("day_first", F.col("event_date").alias("day_reused"))
            .agg(F.count(F.lit(1)).alias("shared_ids")))


@register("id_day_overlap", q("E", f"""
    SELECT a.d AS day_a, b.d AS day_b, coalesce(n, 0) AS shared_ids
    FROM days a JOIN days b ON a.d < b.d
    LEFT JOIN (SELECT x.event_date AS da, y.event_date AS db, count(DISTINCT x.event_id) AS n
               FROM e_events x JOIN e_events y ON x.event_id = y.event_id AND x.event_date < y.event_date GROUP BY 1, 2) s
      ON s.da = a.d AND s.db = b.d""", extra=[
    f"days AS (SELECT CAST(unnest(generate_series(DATE '{A.EVENT_WINDOW[0]}', DATE '{A.EVENT_WINDOW[1]}', INTERVAL 1 DAY)) AS DATE) AS d)"]),
    ops="H3")
def id_day_overlap(spark, sf_dir):
    """Ids that each pair of days of the window shares, pairs that share none included."""
    return day_overlap(Lake(spark, sf_dir).stream_events(), day_pairs(*A.EVENT_WINDOW))


@register("bronze_parity", q("P", """
    SELECT count(*) AS rows, count(*) AS equal_rows FROM p_rows"""), ops="B1")
def bronze_parity(spark, sf_dir):
    """Single-parse envelope vs five path extractions: every row must agree."""
    raw = Lake(spark, sf_dir).pr_raw()
    paths = {"id": "$.id", "type": "$.type", "created_at": "$.created_at",
             "actor_login": "$.actor.login", "repo_name": "$.repo.name"}
    one = B.to_bronze(raw)
    five = B.to_bronze_paths(raw)
    env = raw.select(F.from_json("value", ENVELOPE).alias("e"),
                     *[F.get_json_object("value", p).alias(c) for c, p in paths.items()])
    fields = {"id": "e.id", "type": "e.type", "created_at": "e.created_at",
              "actor_login": "e.actor.login", "repo_name": "e.repo.name"}
    same = F.lit(True)
    for c, f in fields.items():
        same = same & F.col(f).eqNullSafe(F.col(c))
    assert one.columns == five.columns
    return env.agg(F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("equal_rows"))

