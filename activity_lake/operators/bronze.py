"""Bronze: raw text + five envelope columns, stamped with the source date.

Map-only: no operator here shuffles. The envelope is parsed once per line with
``from_json`` on an explicit five-field schema (Spark prunes everything else),
instead of five independent path walks over the same text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENVELOPE, LINE, PR_TYPES, RETAINED_TYPES


def to_bronze(raw: DataFrame, payload: bool = False) -> DataFrame:
    """``value, file_date[, file_hour]`` -> bronze columns.

    Malformed or blank lines keep a row with NULL envelope columns (never
    dropped here: the volume profile and reconciliation count them).
    ``event_date`` is the date of the source *file*, not of the event.

    ``payload=True`` adds ``pr``, the part of a pull-request payload that silver reads: the
    same parse gives it, so silver doesn't parse the text again.
    """
    env = F.from_json(F.col("value"), LINE if payload else ENVELOPE)
    pr = [F.when(F.col("_env.type").isin(list(PR_TYPES)), F.struct(F.col("_env.payload").alias("payload"))).alias("pr")] if payload else []
    return (raw
            .withColumn("_env", env)
            .select(
                F.col("value").alias("event_json"),
                F.col("_env.id").alias("id"),
                F.col("_env.type").alias("type"),
                F.col("_env.created_at").alias("created_at"),
                F.col("_env.actor.login").alias("actor_login"),
                F.col("_env.repo.name").alias("repo_name"),
                F.to_date(F.col("file_date")).alias("event_date"),
                *pr,
            ))


def to_bronze_paths(raw: DataFrame) -> DataFrame:
    """Reference-style extraction with one ``get_json_object`` per column.

    Kept as the parity oracle for :func:`to_bronze` (same answers, five parses).
    """
    v = F.col("value")
    return raw.select(
        v.alias("event_json"),
        F.get_json_object(v, "$.id").alias("id"),
        F.get_json_object(v, "$.type").alias("type"),
        F.get_json_object(v, "$.created_at").alias("created_at"),
        F.get_json_object(v, "$.actor.login").alias("actor_login"),
        F.get_json_object(v, "$.repo.name").alias("repo_name"),
        F.to_date(F.col("file_date")).alias("event_date"),
    )


def parse_type_list(text: str) -> list[str]:
    """``'A, B,,C'`` -> ``['A', 'B', 'C']`` (driver-side parameter parsing)."""
    return [t.strip() for t in text.split(",") if t.strip()]


def retain_payload(bronze: DataFrame, types: Iterable[str] | str | None = RETAINED_TYPES) -> DataFrame:
    """Keep the JSON text (and ``pr``) only for the listed event types; no row is dropped.

    ``types=None`` (or ``"all"``) keeps every payload.
    """
    if types is None or types == "all":
        return bronze
    if isinstance(types, str):
        types = parse_type_list(types)
    kept = F.col("type").isin(list(types))
    return bronze.withColumns({c: F.when(kept, F.col(c)) for c in ("event_json", "pr") if c in bronze.columns})
