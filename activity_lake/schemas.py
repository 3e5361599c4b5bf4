"""Explicit schemas. Nothing is inferred anywhere in the pipeline.

JSON leaves are declared STRING on purpose: a JSON number or boolean read into a
STRING field keeps its text, while a JSON string read into a BIGINT field would
silently become NULL. Typing happens afterwards with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Envelope: the five columns bronze extracts next to the raw text.
ENVELOPE = T.StructType([
    T.StructField("id", S),
    T.StructField("type", S),
    T.StructField("created_at", S),
    T.StructField("actor", T.StructType([T.StructField("login", S)])),
    T.StructField("repo", T.StructType([T.StructField("name", S)])),
])

# The part of a pull-request payload silver reads (both formats).
PR_PAYLOAD = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("action", S),
        T.StructField("pull_request", T.StructType([
            T.StructField("id", S),
            T.StructField("number", S),
            T.StructField("created_at", S),
            T.StructField("merged_at", S),
            T.StructField("closed_at", S),
            T.StructField("merged", S),
            T.StructField("additions", S),
            T.StructField("deletions", S),
            T.StructField("user", T.StructType([
                T.StructField("login", S),
                T.StructField("type", S),
            ])),
            T.StructField("base", T.StructType([
                T.StructField("repo", T.StructType([T.StructField("language", S)])),
            ])),
        ])),
        T.StructField("review", T.StructType([
            T.StructField("state", S),
            T.StructField("submitted_at", S),
        ])),
    ])),
])

# A whole line for silver: the envelope and the pull-request payload, in one parse.
LINE = T.StructType([*ENVELOPE.fields, *PR_PAYLOAD.fields])

# Raw line as read from an hourly file, plus the source partition keys.
RAW = T.StructType([
    T.StructField("value", S),
    T.StructField("file_date", S),
    T.StructField("file_hour", T.IntegerType()),
])

BRONZE = T.StructType([
    T.StructField("event_json", S),
    T.StructField("id", S),
    T.StructField("type", S),
    T.StructField("created_at", S),
    T.StructField("actor_login", S),
    T.StructField("repo_name", S),
    T.StructField("event_date", T.DateType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", S),
    T.StructField("created_ts", T.TimestampType()),
    T.StructField("actor", S),
    T.StructField("repo", S),
    T.StructField("repo_owner", S),
    T.StructField("event_date", T.DateType()),
    T.StructField("is_bot", T.BooleanType()),
    T.StructField("actor_class", S),
])

_TS, _L, _I, _B = T.TimestampType(), T.LongType(), T.IntegerType(), T.BooleanType()
PR_EVENTS = T.StructType([T.StructField(n, t) for n, t in (
    ("event_id", _L), ("event_type", S), ("created_ts", _TS), ("actor", S), ("repo", S), ("event_date", T.DateType()),
    ("pr_id", _L), ("pr_number", _I), ("action", S), ("repo_language", S), ("pr_author", S), ("pr_author_type", S),
    ("lines_added", _I), ("lines_deleted", _I), ("review_state", S), ("pr_created_ts", _TS), ("pr_merged_ts", _TS),
    ("pr_closed_ts", _TS), ("review_submitted_ts", _TS), ("pr_merged", _B), ("payload_format", S), ("is_merge", _B),
    ("is_bot", _B), ("actor_class", S))])

# The key index of the in-stream dedup: ids only, by day and micro-batch.
KEYS = T.StructType([T.StructField("event_id", _L), T.StructField("event_date", T.DateType()), T.StructField("batch", _I)])

RUN_LOG = T.StructType([
    T.StructField("layer", S),
    T.StructField("event_date", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("bytes_in", T.LongType()),
    T.StructField("bytes_out", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("logged_at", T.TimestampType()),
])

# Payload types whose full JSON bronze keeps by default (the others keep only
# the extracted envelope columns).
PR_TYPES = ("PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent")
RETAINED_TYPES = PR_TYPES + ("IssuesEvent", "IssueCommentEvent")

FULL = "full"
REDUCED = "reduced"
