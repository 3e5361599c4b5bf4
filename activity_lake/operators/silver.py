"""Silver: typed, deduplicated, classified events and pull-request events.

Plan shape (deliberate, Catalyst cannot derive it): every JSON extraction and
cast happens *before* the dedup aggregate, so the single shuffle of each table
carries short typed columns only, never the raw text. The dedup key is the
composite ``(event_id, event_date)``: the reduced format reuses ids on other
dates, so deduplicating by id alone would erase real events. A stored layer's rows
have a position, so there the shuffle carries key and position alone (:func:`dedup_layer`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.actors import classify_actor, is_bot
from ..functions.timefn import parse_iso
from ..schemas import FULL, PR_PAYLOAD, PR_TYPES, REDUCED

EVENT_KEY = ["event_id", "event_date"]


def _envelope_typed(bronze: DataFrame) -> list:
    return [
        F.expr("try_cast(id AS BIGINT)").alias("event_id"),
        F.col("type").alias("event_type"),
        parse_iso(F.col("created_at")).alias("created_ts"),
        F.col("actor_login").alias("actor"),
        F.col("repo_name").alias("repo"),
    ]


def dedup_events(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per ``(event_id, event_date)``; duplicates are byte-identical,
    so any survivor is correct. Rows without an id (malformed lines) are
    dropped first - they are counted by the volume profile instead.

    The survivor is kept as one struct: one value in the aggregate's buffer instead of a
    value and a flag for each of some twenty columns, in the sort, the shuffle and the merge."""
    key = key or EVENT_KEY
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.where(F.col(key[0]).isNotNull()).distinct()
    kept = df.where(F.col(key[0]).isNotNull()).groupBy(*key).agg(F.first(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in key else F.col("_kept")[c].alias(c) for c in df.columns])


def _position(store: Callable | None) -> list:
    """A stored layer's row is known by its file and its number in the file, as 64 bits of both."""
    return [F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_position")] if store else []


def dedup_layer(df: DataFrame, store: Callable, key: list[str] | None = None) -> DataFrame:
    """:func:`dedup_events` for the rows of a stored layer with their ``_position``.

    Keys and positions are counted by hash first; the keys that occur more than once are stored with
    the position of one of their rows. The rows themselves are read again and joined with these few keys: no
    wide row is sorted or shuffled, unless the repeated keys are too many to broadcast."""
    key = key or EVENT_KEY
    rows = df.where(F.col(key[0]).isNotNull())
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_kept"))
    kept = store(counted.where(F.col("_n") > 1).select(*[F.col(c).alias(f"_{c}") for c in key], "_kept"))
    # Only the first column of the key is never NULL; equal keys with a NULL in another are one key too.
    same = [F.col(key[0]) == F.col(f"_{key[0]}")] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key[1:]]
    return (rows.join(kept, same, "left").where(F.col("_kept").isNull() | (F.col("_kept") == F.col("_position")))
            .select(*[c for c in df.columns if c != "_position"]))


def _deduped(df: DataFrame, dedup: bool, store: Callable | None) -> DataFrame:
    if not dedup:
        return df.drop("_position")
    return dedup_layer(df, store) if store else dedup_events(df)


def _classified(events: DataFrame) -> DataFrame:
    """Adds the bot flag and class. They follow from the actor, so they are derived after the
    dedup and neither sorted nor shuffled."""
    return (events.withColumn("is_bot", is_bot(F.col("actor")))
            .withColumn("actor_class", classify_actor(F.col("actor"))))


def to_events(bronze: DataFrame, dedup: bool = True, store: Callable | None = None) -> DataFrame:
    """Typed events of every type (no JSON column survives the projection).

    ``store`` writes a frame and reads it back; with it, ``bronze`` is a scan of stored files, whose
    copies are found by key and position (:func:`dedup_layer`)."""
    ev = _deduped(bronze.select(*_envelope_typed(bronze), F.col("event_date"), *_position(store)), dedup, store)
    return (_classified(ev.withColumn("repo_owner", F.substring_index(F.col("repo"), "/", 1)))
            .select("event_id", "event_type", "created_ts", "actor", "repo",
                    "repo_owner", "event_date", "is_bot", "actor_class"))


def to_pr_events(bronze: DataFrame, dedup: bool = True, store: Callable | None = None) -> DataFrame:
    """Pull-request events with the payload flattened.

    One ``from_json`` per row on an explicit schema replaces fourteen path
    walks. The payload format is detected by *field presence* (the full format
    carries ``pull_request.created_at``), never by date, and tested on the text
    before parsing so a malformed instant cannot flip it. Bronze that has the parsed
    payload (``pr``) isn't parsed again, nor is its text read. ``store`` as in :func:`to_events`.
    """
    parsed = "pr" in bronze.columns
    p = F.col("pr") if parsed else F.from_json(F.col("event_json"), PR_PAYLOAD)
    pr = (bronze
          .where(F.col("type").isin(list(PR_TYPES)) & F.col("pr" if parsed else "event_json").isNotNull())
          .select(*_envelope_typed(bronze), F.col("event_date"), p.alias("_p"), *_position(store))
          .select(
              "event_id", "event_type", "created_ts", "actor", "repo", "event_date",
              F.expr("try_cast(_p.payload.pull_request.id AS BIGINT)").alias("pr_id"),
              F.expr("try_cast(_p.payload.pull_request.number AS INT)").alias("pr_number"),
              F.col("_p.payload.action").alias("action"),
              F.col("_p.payload.pull_request.created_at").alias("_created_txt"),
              F.col("_p.payload.pull_request.merged_at").alias("_merged_txt"),
              F.col("_p.payload.pull_request.closed_at").alias("_closed_txt"),
              F.col("_p.payload.pull_request.merged").alias("_merged_flag"),
              F.col("_p.payload.pull_request.base.repo.language").alias("repo_language"),
              F.col("_p.payload.pull_request.user.login").alias("pr_author"),
              F.col("_p.payload.pull_request.user.type").alias("pr_author_type"),
              F.expr("try_cast(_p.payload.pull_request.additions AS INT)").alias("lines_added"),
              F.expr("try_cast(_p.payload.pull_request.deletions AS INT)").alias("lines_deleted"),
              F.col("_p.payload.review.state").alias("review_state"),
              F.col("_p.payload.review.submitted_at").alias("_review_txt"),
              *(["_position"] if store else []),
          ))
    merged_flag = F.col("_merged_flag") == F.lit("true")      # three-valued on purpose
    action = F.col("action")
    out = (pr
           .withColumn("pr_created_ts", parse_iso(F.col("_created_txt")))
           .withColumn("pr_merged_ts", parse_iso(F.col("_merged_txt")))
           .withColumn("pr_closed_ts", parse_iso(F.col("_closed_txt")))
           .withColumn("review_submitted_ts", parse_iso(F.col("_review_txt")))
           .withColumn("pr_merged", merged_flag)
           .withColumn("payload_format",
                       F.when(F.col("_created_txt").isNotNull(), F.lit(FULL)).otherwise(F.lit(REDUCED)))
           # Two conventions for a merge: reduced format has its own action,
           # full format closes with merged=true. Never NULL.
           .withColumn("is_merge", F.coalesce(
               (action == F.lit("merged")) | ((action == F.lit("closed")) & merged_flag),
               F.lit(False)))
           .drop("_created_txt", "_merged_txt", "_closed_txt", "_merged_flag", "_review_txt"))
    return _classified(_deduped(out, dedup, store))


def stage(df: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Staging view: clip to the analysis window on the partition column.

    A closed range on ``event_date`` with DATE literals, so it prunes
    partitions on a layer scan and pushes down on a plain scan.
    """
    if lo is not None:
        df = df.where(F.col("event_date") >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.where(F.col("event_date") <= F.lit(hi).cast("date"))
    return df


def partition_in(df: DataFrame, days: list[str]) -> DataFrame:
    """IN-list partition predicate (static pruning)."""
    return df.where(F.col("event_date").isin([F.lit(d).cast("date") for d in days]))
