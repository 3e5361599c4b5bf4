"""Registered queries: planning (C6, C7, H2) and feed profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import planning as PL
from ..operators import profiling as PF
from ..operators.quality import hours_per_day
from ..sources import raw as RAW
from . import adapters as A
from .oracle import q
from .pipeline import Lake
from .registry import register

E_LO, E_HI = A.EVENT_WINDOW
GAPS = [("2024-01-10", "2024-01-12")]

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"

# Typed view of the profiling feed: adapter P + push events + adapter E, plus
# three malformed lines (one blank) that no typed table can carry.
PROF_CTE = f"""prof AS (
    SELECT event_type AS type, {_ISO.format('created_ts')} AS created_at, event_id AS id, actor,
           full_fmt, action, st, k, is_end
    FROM (SELECT r.*, o.st, o.k, r.event_id % 100 = 1 AND r.event_type = 'PullRequestEvent' AS is_end
          FROM p_rows r JOIN p_o o ON o.k = r.pr_id) x
    UNION ALL
    SELECT 'PushEvent', {_ISO.format('opened_ts')}, k * 100 + 2, author, full_fmt, NULL, st, k, false FROM p_o
    UNION ALL
    SELECT event_type, {_ISO.format('created_ts')}, event_id, actor, NULL, NULL, NULL, NULL, false FROM e_typed)"""


def _pq(select: str, *extra: str) -> str:
    return q(("P", "E"), select, extra=[PROF_CTE, *extra])


def _pct2(num: str, den: str) -> str:
    return f"floor(({num} * 20000 + {den}) / (2 * {den})) / 100.0"


# ---------------------------------------------------------------- planning
@register("pending_days", q("E", f"""
    SELECT d.day FROM (SELECT CAST(unnest(generate_series(DATE '{E_LO}', DATE '{E_HI}', INTERVAL 1 DAY)) AS DATE) AS day) d
    WHERE NOT (d.day BETWEEN DATE '{GAPS[0][0]}' AND DATE '{GAPS[0][1]}')
      AND d.day NOT IN (SELECT event_date FROM e_events GROUP BY event_date HAVING count(DISTINCT hour(created_ts)) = 24)
      AND d.day IN (SELECT DISTINCT event_date FROM e_typed)"""), ops="C6 H2")
def pending_days(spark, sf_dir):
    """Days still to (re)process: wanted - known gaps - complete days, among
    days whose raw input exists. A day counts as done only with 24 hours."""
    lake = Lake(spark, sf_dir)
    done = (hours_per_day(lake.stream_events()).where(F.col("hours") == 24)
            .select(F.col("event_date").alias("day")))
    available = RAW.file_inventory(spark, lake.raw_files()).select(F.col("file_date").alias("day"))
    return PL.pending_days(spark, E_LO, E_HI, done=done, gaps=GAPS, available=available)


@register("missing_hours", q("E", f"""
    SELECT CAST(t AS DATE) AS day, CAST(hour(t) AS INTEGER) AS hour
    FROM (SELECT unnest(generate_series(TIMESTAMP '{E_LO} 00:00:00', TIMESTAMP '{E_HI} 23:00:00', INTERVAL 1 HOUR)) AS t) h
    WHERE (CAST(t AS DATE), hour(t)) NOT IN (SELECT DISTINCT event_date, hour(created_ts) FROM e_typed)"""),
    ops="C7")
def missing_hours(spark, sf_dir):
    """Hours of the window with no source file, from the file listing."""
    inv = (RAW.file_inventory(spark, Lake(spark, sf_dir).raw_files())
           .select(F.col("file_date").alias("day"), F.col("file_hour").alias("hour")))
    return PL.missing_hours(spark, E_LO, E_HI, inv)


# ---------------------------------------------------------------- profiling
def _raw(spark, sf_dir):
    return Lake(spark, sf_dir).profile_raw()


@register("p_volume", _pq("""
    SELECT count(*) + any_value(r.bad + r.blank) AS lines, any_value(r.blank) AS blank_lines, count(*) AS events,
           any_value(r.bad) AS unparseable_lines,
           min(created_at) AS min_created_at, max(created_at) AS max_created_at
    FROM prof, (SELECT count(*) FILTER (WHERE r_regionkey % 3 < 2) AS bad, count(*) FILTER (WHERE r_regionkey % 3 = 2) AS blank FROM region) r"""), ops="K1")
def p_volume(spark, sf_dir):
    return PF.volume(_raw(spark, sf_dir)).drop("text_bytes")


@register("p_types", _pq(f"""
    SELECT type, count(*) AS events, {_pct2('count(*)', 'sum(count(*)) OVER ()')} AS pct
    FROM prof GROUP BY type"""), ops="K2 G4")
def p_types(spark, sf_dir):
    return PF.type_frequency(_raw(spark, sf_dir))


def _paths_sql() -> str:
    """Paths of the adapters' documents: (types, path, value type, condition, occurrences)."""
    prs = "type IN ('PullRequestEvent', 'PullRequestReviewEvent')"
    pr, review, push, ev = "type = 'PullRequestEvent'", "type = 'PullRequestReviewEvent'", "type = 'PushEvent'", "k IS NULL"
    p = "payload.pull_request"
    rules = [(prs, "payload.action", "str", "true"), (prs, "payload.number", "int", "true"), (prs, p, "dict", "true"),
             (prs, f"{p}.id", "int", "true"), (prs, f"{p}.number", "int", "true"), (prs, f"{p}.base", "dict", "true"),
             (prs, f"{p}.base.repo", "dict", "true"), (prs, f"{p}.base.repo.language", "str", "full_fmt AND k % 12 <> 0"),
             *[(prs, f"{p}.{x}", t, "full_fmt") for x, t in (("created_at", "str"), ("user", "dict"), ("user.login", "str"),
                                                             ("user.type", "str"), ("additions", "int"), ("deletions", "int"))],
             (pr, f"{p}.closed_at", "str", "full_fmt AND is_end"), (pr, f"{p}.merged", "bool", "full_fmt AND is_end"),
             (pr, f"{p}.merged_at", "str", "full_fmt AND is_end AND st = 'F'"),
             *[(review, f"payload.review{x}", t, "true") for x, t in (("", "dict"), (".state", "str"), (".submitted_at", "str"))],
             (push, "payload.ref", "str", "true"), (push, "payload.size", "int", "full_fmt"), (push, "payload.commits", "list", "full_fmt")]
    parts = [f"SELECT type AS event_type, '{path}' AS path, '{t}' AS value_type, count(*) AS occurrences FROM prof "
             f"WHERE {types} AND {cond} GROUP BY type" for types, path, t, cond in rules]
    parts += [f"SELECT type, 'payload.commits[]{x}', '{t}', CAST(sum(least(k % 30, 20)) AS BIGINT) FROM prof WHERE {push} AND full_fmt "
              "AND k % 30 > 0 GROUP BY type" for x, t in (("", "dict"), (".sha", "str"))]
    parts += [f"SELECT event_type, 'payload.{x}', '{t}', count(*) FROM e_props WHERE {cond} GROUP BY event_type"
              for x, t, cond in (("props", "dict", "props IS NOT NULL"), ("props.k", "int", "json_extract_string(props, '$.k') IS NOT NULL"),
                                 ("value", "float", "value IS NOT NULL"))]
    e_props = ("e_props AS (SELECT event_type, value, props FROM events UNION ALL SELECT event_type, value, props FROM events "
               "WHERE event_id % 97 = 0 UNION ALL SELECT 'reused', value, props FROM events WHERE event_id % 89 = 0)")
    return _pq("\nUNION ALL\n".join(parts), e_props)


@register("p_paths", _paths_sql(), ops="K3")
def p_paths(spark, sf_dir):
    """Observed-schema profile of every type, level and array element."""
    return PF.observed_paths(_raw(spark, sf_dir))


_PR = "type = 'PullRequestEvent'"


@register("p_key_coverage", _pq(f"""
    SELECT object, key, events, type_events, {_pct2('events', 'type_events')} AS pct FROM (
      SELECT 'payload.pull_request' AS object, key, count(*) AS events,
             max(n) AS type_events
      FROM (SELECT unnest(CASE WHEN full_fmt THEN
                     (CASE WHEN is_end THEN
                        (CASE WHEN st = 'F' THEN ['id','number','created_at','merged_at','closed_at','merged','user','additions','deletions','base']
                              ELSE ['id','number','created_at','closed_at','merged','user','additions','deletions','base'] END)
                      ELSE ['id','number','created_at','user','additions','deletions','base'] END)
                   ELSE ['id','number','base'] END) AS key,
                   count(*) OVER () AS n
            FROM prof WHERE {_PR}) t GROUP BY key
      UNION ALL
      SELECT 'payload', key, count(*), max(n)
      FROM (SELECT unnest(CASE WHEN full_fmt THEN ['ref','size','commits'] ELSE ['ref'] END) AS key,
                   count(*) OVER () AS n
            FROM prof WHERE type = 'PushEvent') t GROUP BY key) x"""), ops="K4")
def p_key_coverage(spark, sf_dir):
    return PF.key_coverage(_raw(spark, sf_dir), ("PullRequestEvent", "payload.pull_request"), ("PushEvent", "payload"))


@register("p_candidate_paths", _pq(f"""
    SELECT path, present, non_null, type_events FROM (
      SELECT 'payload.pull_request.base.repo.language' AS path,
             count(*) FILTER (WHERE full_fmt AND k % 12 <> 0) AS present,
             count(*) FILTER (WHERE full_fmt AND k % 12 <> 0) AS non_null, count(*) AS type_events
      FROM prof WHERE {_PR}
      UNION ALL SELECT 'payload.pull_request.head.repo.language', 0, 0, count(*) FROM prof WHERE {_PR}
      UNION ALL SELECT 'repo.language', 0, 0, count(*) FROM prof WHERE {_PR}
      UNION ALL SELECT 'payload.repository.language', 0, 0, count(*) FROM prof WHERE {_PR}) x"""),
    ops="K5")
def p_candidate_paths(spark, sf_dir):
    return PF.candidate_paths(_raw(spark, sf_dir))


@register("p_language_values", _pq(f"""
    SELECT 'lang' || CAST(k % 6 AS VARCHAR) AS value, count(*) AS events
    FROM prof WHERE {_PR} AND full_fmt AND k % 12 <> 0
    GROUP BY 1 ORDER BY events DESC, value LIMIT 20"""), ops="K5 G4")
def p_language_values(spark, sf_dir):
    return PF.top_values(_raw(spark, sf_dir), "payload.pull_request.base.repo.language",
                         "PullRequestEvent", 20)


@register("p_truncation", _pq("""
    SELECT count(*) AS events, count(*) FILTER (WHERE full_fmt) AS with_size,
           0 AS with_distinct_size, count(*) FILTER (WHERE full_fmt AND k % 30 > 20) AS truncated,
           CAST(max(CASE WHEN full_fmt THEN least(k % 30, 20) ELSE 0 END) AS INTEGER) AS max_commits,
           floor((count(*) FILTER (WHERE full_fmt AND k % 30 > 20) * 20000 + count(*) FILTER (WHERE full_fmt))
                 / (2 * nullif(count(*) FILTER (WHERE full_fmt), 0))) / 100.0 AS truncated_pct
    FROM prof WHERE type = 'PushEvent'"""), ops="K6")
def p_truncation(spark, sf_dir):
    return PF.truncation(_raw(spark, sf_dir))


@register("p_bot_signals", _pq(f"""
    SELECT 'events_with_login' AS signal, count(*) AS n FROM prof
    UNION ALL SELECT 'events_bot_suffix', count(*) FILTER (WHERE ends_with(actor, '[bot]')) FROM prof
    UNION ALL SELECT 'distinct_bot_logins', count(DISTINCT actor) FILTER (WHERE ends_with(actor, '[bot]')) FROM prof
    UNION ALL SELECT 'payload.pull_request.user.type=' ||
                     CASE WHEN ends_with(o.author, '[bot]') THEN 'Bot' ELSE 'User' END, count(*)
      FROM prof p JOIN p_o o ON o.k = p.k
      WHERE p.type IN ('PullRequestEvent', 'PullRequestReviewEvent') AND p.full_fmt GROUP BY 1"""),
    ops="K7")
def p_bot_signals(spark, sf_dir):
    return PF.bot_signals(_raw(spark, sf_dir))


@register("p_top_bots", _pq(f"""
    SELECT actor AS login, count(*) AS events, {_pct2('count(*)', '(SELECT count(*) FROM prof)')} AS pct
    FROM prof WHERE actor LIKE '%[bot]' GROUP BY actor ORDER BY events DESC, login LIMIT 20"""), ops="K7 G4")
def p_top_bots(spark, sf_dir):
    return PF.top_bots(_raw(spark, sf_dir))


@register("p_field_matrix", _pq(f"""
    SELECT action, count(*) AS events,
           count(*) FILTER (WHERE full_fmt) AS created_at, 0 AS updated_at,
           count(*) FILTER (WHERE full_fmt AND is_end) AS closed_at,
           count(*) FILTER (WHERE full_fmt AND is_end AND st = 'F') AS merged_at,
           count(*) FILTER (WHERE full_fmt AND is_end) AS merged
    FROM prof WHERE {_PR} GROUP BY action"""), ops="K8")
def p_field_matrix(spark, sf_dir):
    return PF.field_matrix(_raw(spark, sf_dir))


@register("p_identifiers", _pq("""
    SELECT type AS event_type, path, CASE WHEN path LIKE '%node_id' THEN 0 ELSE count(*) END AS events
    FROM prof, (SELECT unnest(['payload.pull_request.id', 'payload.pull_request.number',
                               'payload.pull_request.node_id', 'payload.number']) AS path) p
    WHERE type IN ('PullRequestEvent', 'PullRequestReviewEvent', 'PullRequestReviewCommentEvent')
    GROUP BY type, path"""), ops="K9")
def p_identifiers(spark, sf_dir):
    return PF.identifier_coverage(_raw(spark, sf_dir))


def _drift_sql() -> str:
    pr, push = _PR, "type = 'PushEvent'"
    has_pr = {"id": "true", "number": "true", "base": "true", "created_at": "full_fmt", "user": "full_fmt", "additions": "full_fmt",
              "deletions": "full_fmt", "merged_at": "full_fmt AND is_end AND st = 'F'", "closed_at": "full_fmt AND is_end",
              "merged": "full_fmt AND is_end", "head": "false"}
    has_push = {"ref": "true", "size": "full_fmt", "commits": "full_fmt", "push_id": "false", "distinct_size": "false", "head": "false"}
    count = lambda c: f"count(*) FILTER (WHERE {c})"
    # The malformed lines stand in files of 1995.
    rows = [("lines", "count(*) + if(y = 1995, (SELECT count(*) FROM region), 0)"), ("events", "count(*)"), ("distinct_types", "count(DISTINCT type)"),
            ("bot_events", count("actor LIKE '%[bot]'")), ("bot_pct", _pct2(count("actor LIKE '%[bot]'"), "count(*)")),
            ("pr_events", count(pr)), ("push_events", count(push)),
            ("pr_language_pct", _pct2(count(f"{pr} AND full_fmt AND k % 12 <> 0"), f"nullif({count(pr)}, 0)"))]
    rows += [(f"pr_key_pct:{k}", _pct2(count(f"{pr} AND {c}"), f"nullif({count(pr)}, 0)")) for k, c in has_pr.items()]
    rows += [(f"push_key_pct:{k}", _pct2(count(f"{push} AND {c}"), f"nullif({count(push)}, 0)")) for k, c in has_push.items()]
    parts = [f"SELECT y AS unit, '{m}' AS metric, CAST({v} AS DOUBLE) AS value FROM pp GROUP BY y" for m, v in rows]
    parts.append(f"SELECT y, 'action:' || action, CAST(count(*) AS DOUBLE) FROM pp WHERE {pr} GROUP BY ALL")
    pp = "pp AS (SELECT *, CAST(substr(created_at, 1, 4) AS INTEGER) AS y FROM prof)"
    return _pq("SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE value IS NOT NULL", pp)


@register("p_drift", _drift_sql(), ops="K10")
def p_drift(spark, sf_dir):
    """Drift of the whole mixed feed across years, broken and blank lines included (bytes
    are checked in tests: they are the serialised lines' own)."""
    return PF.drift(_raw(spark, sf_dir), F.substring("file_date", 1, 4).cast("int")).where(F.col("metric") != "bytes")


@register("p_examples", _pq("""
    SELECT type, arg_min(id, (created_at, id)) AS id, min(created_at) AS created_at,
           type AS json_type, CAST(arg_min(id, (created_at, id)) AS VARCHAR) AS json_id,
           arg_min(actor, (created_at, id)) AS json_login
    FROM prof GROUP BY type"""), ops="K11")
def p_examples(spark, sf_dir):
    """One real line per type; the line's text is checked by the fields read back from it."""
    ex = PF.examples(_raw(spark, sf_dir))
    return ex.select("type", "id", "created_at", F.get_json_object("json", "$.type").alias("json_type"),
                     F.get_json_object("json", "$.id").alias("json_id"), F.get_json_object("json", "$.actor.login").alias("json_login"))

