"""Feed profiling over any number of raw files.

All operators read raw lines ``(value, file_date[, file_hour])`` and are
distributed aggregations; nothing is walked in the driver. The observed-schema
walk (K3) parses each line once in the task and pre-aggregates there, since
arbitrarily nested keys aren't columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: candidate paths and signals the profiler measures ---------
LANGUAGE_CANDIDATE_PATHS = (
    "payload.pull_request.base.repo.language",
    "payload.pull_request.head.repo.language",
    "repo.language",
    "payload.repository.language",
)
TEMPORAL_FIELDS = ("created_at", "updated_at", "closed_at", "merged_at", "merged")
PR_IDENTIFIER_PATHS = ("payload.pull_request.id", "payload.pull_request.number",
                       "payload.pull_request.node_id", "payload.number")
USER_TYPE_PATHS = ("payload.pull_request.user.type", "payload.issue.user.type",
                   "payload.sender.type", "actor.type")
PR_TYPES = ("PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent")
PR_DRIFT_KEYS = ("id", "number", "created_at", "merged_at", "closed_at", "merged", "user", "additions",
                 "deletions", "base", "head")
PUSH_DRIFT_KEYS = ("push_id", "size", "distinct_size", "commits", "ref", "head")
# ----------------------------------------------------------------------------


def _jp(path: str) -> str:
    return "$." + path


def _typed(raw: DataFrame) -> DataFrame:
    """Raw lines parsed to VARIANT, with the blank flag (``j`` NULL = unparseable)."""
    v = F.col("value")
    return raw.select(
        "value", "file_date",
        (F.trim(F.coalesce(v, F.lit(""))) == F.lit("")).alias("blank"),
        F.try_parse_json(v).alias("j"))


def _of_type(raw: DataFrame, types: Sequence[str] | str, keep_type: bool = False) -> DataFrame:
    """Lines of the given event type(s), selected by a one-field path read
    (cheaper than a full VARIANT parse when only the text is inspected
    afterwards). The type is projected only when the caller groups by it:
    a filter on a projected expression is pushed below the projection and the
    path would be read twice."""
    types = [types] if isinstance(types, str) else list(types)
    et = F.get_json_object(F.col("value"), "$.type")
    if keep_type:
        return raw.select("value", "file_date", et.alias("event_type")).where(F.col("event_type").isin(types))
    return raw.where(et.isin(types)).select("value", "file_date")


def _pct2(num: Column, den: Column) -> Column:
    """``round(100 * num / den, 2)`` half-up, exactly, on non-negative counts."""
    return F.floor((num * 20000 + den) / (den * 2)) / F.lit(100.0)


def _with_total(rows: DataFrame, total: Column) -> DataFrame:
    """rows with `_total`, an aggregate over all of them: one row, joined to each (no window
    that would bring all rows to one task)."""
    one = F.lit(1).alias("_one")
    return rows.select("*", one).join(rows.agg(total.alias("_total")).select("_total", one), "_one").drop("_one")


# -------------------------------------------------------------------- K1
def volume(raw: DataFrame) -> DataFrame:
    """Lines, blank lines, parseable events, unparseable lines, text bytes,
    min/max ``created_at`` (as text, like the feed)."""
    t = _typed(raw)
    ok = ~F.col("blank") & F.col("j").isNotNull()
    created = F.when(ok, F.expr("try_variant_get(j, '$.created_at', 'string')"))
    return t.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("blank")).alias("blank_lines"),
        F.count_if(ok).alias("events"),
        F.count_if(~F.col("blank") & F.col("j").isNull()).alias("unparseable_lines"),
        F.sum(F.octet_length("value")).alias("text_bytes"),
        F.min(created).alias("min_created_at"),
        F.max(created).alias("max_created_at"))


# -------------------------------------------------------------------- K2, G4
def type_frequency(raw: DataFrame, k: int | None = None) -> DataFrame:
    """Events per type with their exact share (percent, 2 dp, half-up)."""
    # Validity is tested inside the aggregate: a filter on the parsed value
    # would be pushed below the projection and parse every line twice.
    t = _typed(raw)
    ok = ~F.col("blank") & F.col("j").isNotNull()
    by = (t.groupBy(F.expr("try_variant_get(j, '$.type', 'string')").alias("type"))
          .agg(F.count_if(ok).alias("events"))
          .where(F.col("events") > 0))
    out = _with_total(by, F.sum("events")).select("type", "events", _pct2(F.col("events"), F.col("_total")).alias("pct"))
    if k is not None:
        out = out.orderBy(F.desc("events"), F.asc("type")).limit(k)
    return out


# -------------------------------------------------------------------- K3
#: A task hands its path counts on when it holds so many distinct paths.
_PATHS_HELD = 200_000
_JSON_TYPES = {type(None): "null", bool: "bool", int: "int", float: "float", str: "str", list: "list", dict: "dict"}


_CONTAINERS = (dict, list)


def _walk(node, tree: list, depth: int | None = None) -> int:
    """Counts everything below a parsed JSON value (all keys and all array elements) into a tree
    of paths, whose nodes are [count by value type, child by key (None: array element)], and returns
    how many new pairs of path and type it holds. depth bounds the levels only if it is given.
    Walks with a list of open containers, so nesting is bounded by memory alone."""
    new = 0
    todo = [(node, tree, depth)] if isinstance(node, _CONTAINERS) else []
    while todo:
        node, (_, below), left = todo.pop()
        if left == 0:
            continue
        left = None if left is None else left - 1
        for key, child in node.items() if isinstance(node, dict) else zip(repeat(None), node):
            at = below.get(key)
            if at is None:
                at = below[key] = [{}, {}]
            kind = type(child)
            if kind in at[0]:
                at[0][kind] += 1
            else:
                at[0][kind] = 1
                new += 1
            if kind in _CONTAINERS:
                todo.append((child, at, left))
    return new


def _tree_rows(kind: str | None, path: str, tree: list):
    """(event type, path, value type, count) of a tree's nodes."""
    todo = [(path, tree)]
    while todo:
        path, (_, below) = todo.pop()
        for key, child in below.items():
            at = path + "[]" if key is None else f"{path}.{key}"
            for t, n in child[0].items():
                yield kind, at, _JSON_TYPES[t], n
            if child[1]:
                todo.append((at, child))


_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|([^ \t\r\n\[\]{},:"]+))')


def _parse(line: str):
    """The value of a JSON text of any depth. The usual parser recurses; a text that is too
    deep for it is put together from its tokens with a list of open containers."""
    try:
        return json.loads(line)
    except RecursionError:
        pass
    # State: what may come next. A container that closes becomes a value of the one around it.
    open_: list = []
    keys: list = []
    result, expect, at, end = None, "value", 0, len(line.rstrip(" \t\r\n"))
    while at < end:
        m = _TOKEN.match(line, at)
        if not m:
            raise ValueError("no JSON")
        at, (mark, text, plain) = m.end(), m.groups()
        if mark in (",", ":"):
            if expect != ("colon" if mark == ":" else "more"):
                raise ValueError("no JSON")
            expect = "value" if mark == ":" or isinstance(open_[-1], list) else "key"
            continue
        if mark in ("]", "}"):
            kind = list if mark == "]" else dict
            if not open_ or not isinstance(open_[-1], kind) or not (expect == "more" or expect.endswith("first")):
                raise ValueError("no JSON")
            open_.pop()
            keys.pop()
            expect = "more" if open_ else "end"
            continue
        if expect.startswith("key"):
            if text is None:
                raise ValueError("no JSON")
            keys[-1], expect = json.loads(text), "colon"
            continue
        if not expect.startswith("value"):
            raise ValueError("no JSON")
        value = {} if mark == "{" else [] if mark == "[" else json.loads(text or plain)
        if not open_:
            result = value
        elif isinstance(open_[-1], list):
            open_[-1].append(value)
        else:
            open_[-1][keys[-1]] = value
        if mark:
            open_.append(value)
            keys.append(None)
            expect = "key first" if mark == "{" else "value first"
        else:
            expect = "more" if open_ else "end"
    if expect != "end":
        raise ValueError("no JSON")
    return result


def observed_paths(raw: DataFrame, types: Sequence[str] | None = None,
                   root: str = "payload", max_depth: int | None = None) -> DataFrame:
    """Every path under ``root`` -> value type -> occurrences, per event type: all
    types, all levels and all array elements unless the caller bounds them.

    Each line is parsed once; a task sends on its distinct (type, path, value type) with
    counts, so the shuffle carries the feed's schema and not its lines. A number is an
    int if its text has neither fraction nor exponent, however large it is. Lines nested
    however deep are walked like others. Lines that
    don't parse, or aren't objects, have no paths (the volume profile counts them).
    """
    wanted = None if types is None else frozenset(types)

    def run(batches):
        trees: dict = {}
        held = 0

        def flush():
            rows = [row for kind, tree in trees.items() for row in _tree_rows(kind, root, tree)]
            trees.clear()
            return pa.RecordBatch.from_pydict({
                "event_type": pa.array([r[0] for r in rows], pa.string()),
                "path": pa.array([r[1] for r in rows], pa.string()),
                "value_type": pa.array([r[2] for r in rows], pa.string()),
                "n": pa.array([r[3] for r in rows], pa.int64())})

        for batch in batches:
            for line in batch.column(0).to_pylist():
                try:
                    event = _parse(line) if line else None
                except ValueError:
                    continue
                if not isinstance(event, dict):
                    continue
                kind = event.get("type")
                if not isinstance(kind, str):
                    kind = None
                if wanted is not None and kind not in wanted:
                    continue
                tree = trees.get(kind)
                if tree is None:
                    tree = trees[kind] = [{}, {}]
                held += _walk(event.get(root), tree, max_depth)
            if held > _PATHS_HELD:
                yield flush()
                held = 0
        yield flush()

    parts = raw.select("value").mapInArrow(run, "event_type string, path string, value_type string, n long")
    return parts.groupBy("event_type", "path", "value_type").agg(F.sum("n").alias("occurrences"))


# -------------------------------------------------------------------- K4
def _keys_at(path: str) -> Column:
    """Keys of the object at ``path`` in their stored (sorted) order; NULL if there is no object."""
    return F.map_keys(F.expr(f"try_variant_get(j, '$.{path}', 'map<string,variant>')"))


def key_coverage(raw: DataFrame, *objects: tuple[str, str]) -> DataFrame:
    """Keys present in the object of each ``(event type, path)``, with coverage over that type's
    events (percent, 2 dp, half-up); a type without events has no rows.

    Each line is parsed once for all objects and gives its key set; equal key sets are counted
    together before they are unrolled, so the keys of a schema cost one row a set and task, and only
    map-like objects (whose sets differ) one row a key."""
    kind = _text_at("type")
    sets = F.filter(F.array(*[F.when(kind == F.lit(t), F.struct(F.lit(i).alias("o"), F.coalesce(_keys_at(p), F.array()).alias("keys")))
                              for i, (t, p) in enumerate(objects)]), lambda x: x.isNotNull())
    per_set = _typed(raw).select(F.inline(sets)).groupBy("o", "keys").agg(F.count(F.lit(1)).alias("n"))
    # A NULL marker beside the keys counts the events themselves.
    marked = F.explode(F.concat(F.array(F.lit(None).cast("string")), "keys"))
    per_key = per_set.select("o", marked.alias("key"), "n").groupBy("o", "key").agg(F.sum("n").alias("events"))
    totals = per_key.where(F.col("key").isNull()).select("o", F.col("events").alias("type_events"))     # one row an object
    names = F.array(*[F.lit(p) for _, p in objects])
    return (per_key.where(F.col("key").isNotNull()).join(totals, "o")
            .select(F.element_at(names, F.col("o") + 1).alias("object"), "key", "events", "type_events",
                    _pct2(F.col("events"), F.col("type_events")).alias("pct")))


# -------------------------------------------------------------------- K5
# K5 and K7-K9 parse a line once: everything is read from the VARIANT inside one
# aggregate. Types are tested in the aggregate too, because a filter on the parsed value
# would be pushed below the projection and parse the line a second time.
def _text_at(path: str) -> Column:
    return F.expr(f"try_variant_get(j, '$.{path}', 'string')")


def _present(path: str) -> Column:
    """The key is there, maybe with a JSON null."""
    return F.expr(f"try_variant_get(j, '$.{path}') IS NOT NULL")


def _non_null(path: str) -> Column:
    return _present(path) & ~F.expr(f"is_variant_null(try_variant_get(j, '$.{path}'))")


def candidate_paths(raw: DataFrame, event_type: str = "PullRequestEvent",
                    paths: Sequence[str] = LANGUAGE_CANDIDATE_PATHS) -> DataFrame:
    """Per candidate path: key present vs value non-NULL, over one event type."""
    own = F.coalesce(_text_at("type") == F.lit(event_type), F.lit(False))
    aggs = [F.count_if(own).alias("_n")]
    for i, p in enumerate(paths):
        aggs += [F.count_if(own & _present(p)).alias(f"p{i}"), F.count_if(own & _non_null(p)).alias(f"v{i}")]
    a = _typed(raw).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"p{i}").alias("present"),
                              F.col(f"v{i}").alias("non_null")) for i, p in enumerate(paths)])
    return (a.select("_n", F.explode(rows).alias("r"))
            .select(F.col("r.path").alias("path"), F.col("r.present").alias("present"),
                    F.col("r.non_null").alias("non_null"), F.col("_n").alias("type_events")))


def top_values(raw: DataFrame, path: str, event_type: str | None = None, k: int = 20) -> DataFrame:
    """Most frequent non-NULL values at a path (key tie-break)."""
    t = _of_type(raw, event_type) if event_type else raw
    val = F.get_json_object("value", _jp(path))
    return (t.where(val.isNotNull()).groupBy(val.alias("value")).agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.desc("events"), F.asc("value")).limit(k))


# -------------------------------------------------------------------- K6
def truncation(raw: DataFrame, event_type: str = "PushEvent") -> DataFrame:
    """Declared ``size`` vs ``commits`` length: truncated count and max length."""
    t = _of_type(raw, event_type)
    size = F.get_json_object("value", "$.payload.size").try_cast("bigint")
    n = F.coalesce(F.json_array_length(F.get_json_object("value", "$.payload.commits")), F.lit(0))
    distinct = F.get_json_object("value", "$.payload.distinct_size").try_cast("bigint")
    a = t.agg(F.count(F.lit(1)).alias("events"),
              F.count(size).alias("with_size"),
              F.count(distinct).alias("with_distinct_size"),
              F.count_if(size > n).alias("truncated"),
              F.max(n).alias("max_commits"))
    return a.withColumn("truncated_pct", F.when(F.col("with_size") > 0, _pct2(F.col("truncated"), F.col("with_size"))))


# -------------------------------------------------------------------- K7
def bot_signals(raw: DataFrame, user_type_paths: Sequence[str] = USER_TYPE_PATHS) -> DataFrame:
    """Rows ``(signal, n)``: login presence, ``[bot]`` suffix events, distinct
    bot logins, and the user-type values seen at each candidate path.

    Each line gives the list of its signals; a bot's login is one of them, so distinct
    logins are the groups of that kind."""
    login = _text_at("actor.login")
    bot = login.endswith("[bot]")
    signals = F.array(F.when(login.isNotNull(), F.lit("events_with_login")), F.when(bot, F.lit("events_bot_suffix")),
                      F.when(bot, F.concat(F.lit("login "), login)),
                      *[F.concat(F.lit(p + "="), _text_at(p)) for p in user_type_paths])
    by = (_typed(raw).select(F.explode(signals).alias("signal")).where(F.col("signal").isNotNull())
          .groupBy("signal").agg(F.count(F.lit(1)).alias("n")))
    own = F.col("signal").startswith("login ")
    return (by.groupBy(F.when(own, F.lit("distinct_bot_logins")).otherwise(F.col("signal")).alias("signal"))
            .agg(F.sum(F.when(own, F.lit(1)).otherwise(F.col("n"))).alias("n")))


def top_bots(raw: DataFrame, k: int = 20) -> DataFrame:
    """The k most active ``[bot]`` logins with their percentage of all events."""
    login = F.get_json_object("value", "$.actor.login")
    # Both uses of the counts need the same columns and filter no key, so that they share one scan and shuffle.
    by = (raw.select(login.alias("login"), F.try_parse_json("value").isNotNull().alias("ok")).groupBy("login")
          .agg(F.count_if("ok").alias("events"), F.bool_or(F.col("login").endswith("[bot]")).alias("bot")))
    total = (by.agg(F.sum("events").alias("total"), F.count_if("bot").alias("bots")).where(F.col("bots") > 0)
             .select("total", F.lit(1).alias("_one")))       # one row
    bots = by.where("bot").orderBy(F.desc("events"), "login").limit(k)
    return bots.withColumn("_one", F.lit(1)).join(total, "_one").select("login", "events", _pct2(F.col("events"), F.col("total")).alias("pct"))


# -------------------------------------------------------------------- K8
def field_matrix(raw: DataFrame, event_type: str = "PullRequestEvent",
                 fields: Sequence[str] = TEMPORAL_FIELDS) -> DataFrame:
    """Per action: events, and how many carry each temporal field non-NULL."""
    own = F.coalesce(_text_at("type") == F.lit(event_type), F.lit(False))
    action = F.when(own, F.coalesce(_text_at("payload.action"), F.lit("(no action)")))
    return (_typed(raw).groupBy(action.alias("action"))
            .agg(F.count_if(own).alias("events"),
                 *[F.count_if(own & _non_null(f"payload.pull_request.{f}")).alias(f) for f in fields])
            .where(F.col("events") > 0))


# -------------------------------------------------------------------- K9
def identifier_coverage(raw: DataFrame, types: Sequence[str] = PR_TYPES,
                        paths: Sequence[str] = PR_IDENTIFIER_PATHS) -> DataFrame:
    """Per event type and identifier path: events where it is non-NULL
    (unpivoted with ``stack``; paths with zero hits are kept)."""
    kind = _text_at("type")
    agg = _typed(raw).groupBy(kind.alias("event_type")).agg(
        F.count_if(kind.isin(list(types))).alias("_own"),
        *[F.count_if(_non_null(p)).alias(f"c{i}") for i, p in enumerate(paths)]).where(F.col("_own") > 0)
    stack = "stack({n}, {pairs}) AS (path, events)".format(
        n=len(paths), pairs=", ".join(f"'{p}', c{i}" for i, p in enumerate(paths)))
    return agg.selectExpr("event_type", stack)


# -------------------------------------------------------------------- K10
def drift(raw: DataFrame, unit: Column) -> DataFrame:
    """Schema drift between file units, as long rows ``(unit, metric, value)``.

    Metrics: lines, bytes, events, distinct types, bot events and their percentage; for
    pull requests and pushes the number of events, the coverage of each known key (percent
    of the type's events) and of the language path; every action with its count. Any unit
    and any action that occurs has rows; a unit without pull requests or pushes has no
    percentages of them.
    """
    kind = _text_at("type")
    is_pr, is_push = kind == "PullRequestEvent", kind == "PushEvent"
    # One parse and one pass: a line gives one bit for each thing it may hold, equal lines of a
    # (unit, type, action) are counted together, then the few groups become rows.
    flags = {"bots": _text_at("actor.login").endswith("[bot]"),
             "language": is_pr & _text_at("payload.pull_request.base.repo.language").isNotNull(),
             **{f"pr_{k}": is_pr & _present(f"payload.pull_request.{k}") for k in PR_DRIFT_KEYS},
             **{f"push_{k}": is_push & _present(f"payload.{k}") for k in PUSH_DRIFT_KEYS}}
    bits = reduce(Column.bitwiseOR, [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(flags.values())])
    t = raw.select(unit.alias("unit"), "value", F.try_parse_json("value").alias("j"))
    lines = t.select("unit", kind.alias("type"), F.when(is_pr, _text_at("payload.action")).alias("action"),
                     F.col("j").isNotNull().alias("ok"), bits.alias("bits"), F.octet_length("value").alias("bytes"))
    cells = (lines.groupBy("unit", "type", "action", "ok", "bits").agg(F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("bytes"))
             .select("unit", "type", "action", "lines", "bytes", F.when(F.col("ok"), F.col("lines")).otherwise(F.lit(0)).alias("events"),
                     *[F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.col("lines")).otherwise(F.lit(0)).alias(n) for i, n in enumerate(flags)]))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("type") == kind, F.col("events"))), F.lit(0))
    n_pr, n_push = of("PullRequestEvent"), of("PushEvent")
    share = lambda c, n: F.when(n > 0, _pct2(F.sum(c), n))
    values = {"lines": total("lines"), "bytes": total("bytes"), "events": total("events"),
              "distinct_types": F.count_distinct("type").cast("double"), "bot_events": total("bots"),
              "bot_pct": share("bots", F.sum("events")), "pr_events": n_pr.cast("double"), "push_events": n_push.cast("double"),
              "pr_language_pct": share("language", n_pr),
              **{f"pr_key_pct:{k}": share(f"pr_{k}", n_pr) for k in PR_DRIFT_KEYS},
              **{f"push_key_pct:{k}": share(f"push_{k}", n_push) for k in PUSH_DRIFT_KEYS}}
    names = list(values)
    # A unit's cells are summed under a NULL key, and an action's under the action as well.
    keyed = cells.withColumn("key", F.explode(F.when(F.col("action").isNull(), F.array(F.lit(None).cast("string")))
                                              .otherwise(F.array(F.lit(None), "action"))))
    wide = keyed.groupBy("unit", "key").agg(*[v.alias(f"m{i}") for i, v in enumerate(values.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate(names)])
    action = F.struct(F.concat(F.lit("action:"), "key").alias("metric"), F.col(f"m{names.index('events')}").alias("value"))
    return (wide.select("unit", F.inline(F.when(F.col("key").isNull(), rows).otherwise(F.array(action))))
            .where(F.col("value").isNotNull()))


# -------------------------------------------------------------------- K11
def examples(raw: DataFrame) -> DataFrame:
    """One real line per event type: the earliest (``created_at``, then id).

    A minimum of texts alone would be a sort-based aggregate, which sorts and spills every line.
    The set beside it (always empty) makes it an object hash aggregate, which holds one line
    for each type in a task; with more than 128 types in a task it goes on by sorting."""
    t = _typed(raw)
    et = F.expr("try_variant_get(j, '$.type', 'string')")
    created = F.expr("try_variant_get(j, '$.created_at', 'string')")
    eid = F.expr("try_variant_get(j, '$.id', 'bigint')")
    best = F.min(F.when(F.col("j").isNotNull(), F.struct(
        created.alias("created_at"), eid.alias("id"), F.col("value").alias("json"))))
    empty = F.collect_set(F.lit(None).cast("boolean"))
    return (t.groupBy(et.alias("type")).agg(best.alias("b"), empty.alias("e"))
            .where(F.col("b").isNotNull() & (F.size("e") == 0))
            .select("type", F.col("b.id").alias("id"), F.col("b.created_at").alias("created_at"),
                    F.col("b.json").alias("json")))
