"""Data-quality checks as rows, and the gate that fails a run.

Every check returns rows ``(check, passed, observed, threshold, detail)``;
:func:`quality_report` unions them and :func:`gate` is the only action. Checks
over one table are computed in a *single* aggregation pass (one job for all
null counts, not one per column); per-day checks group by the partition column.
The report is bounded by the number of checks, so collecting it is safe.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FULL

# --- fixed values: thresholds of the reference gate -------------------------
MANDATORY_COLUMNS = ("event_id", "event_type", "created_ts", "actor", "actor_class")
NULL_RATE_MAX_PCT = {"repo": 0.01}
FULL_FORMAT_MIN_COVERAGE_PCT = {"pr_created_ts": 99.0, "pr_author": 99.0, "repo_language": 80.0}
RECONCILE_TOLERANCE = 0.001
#: Percent of bronze lines that may lack an event id before the gate fails.
UNPARSEABLE_MAX_PCT = 0.1
# ----------------------------------------------------------------------------

CHECK_COLS = ["check", "passed", "observed", "threshold", "detail"]


def _row(check: str, passed: Column, observed: Column, threshold: float | Column,
         detail: Column | None = None) -> list[Column]:
    return [F.lit(check).alias("check"), passed.alias("passed"),
            observed.cast("double").alias("observed"),
            (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).cast("double").alias("threshold"),
            (detail if detail is not None else F.lit(None).cast("string")).alias("detail")]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _rows(agg: DataFrame, rows: Sequence[list[Column]]) -> DataFrame:
    """Several check rows from ONE aggregate row: an array of row structs is
    exploded, so the aggregate (and its scan) runs once - never re-planned per
    check as a union of selects would be."""
    structs = [F.struct(*r) for r in rows]
    return agg.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


# -------------------------------------------------------------------- H3
def day_pairs(lo, hi) -> list[tuple]:
    """All pairs (earlier, later) of the days ``lo`` .. ``hi``."""
    d0, d1 = (d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d) for d in (lo, hi))
    days = [d0 + _dt.timedelta(days=i) for i in range((d1 - d0).days + 1)]
    return [(a, b) for i, a in enumerate(days) for b in days[i + 1:]]


def day_overlap(events: DataFrame, pairs: Sequence[tuple]) -> DataFrame:
    """H3: ids that both days of each given pair hold, pairs without any included.

    One aggregate by id keeps a bitmap of the listed days (64 a number, so its buffer is fixed-width
    and combined map-side); an id seen on one day ends there, another one is counted
    for the given pairs that its bitmap holds. The pairs are a parameter, not data."""
    spark = events.sparkSession
    pairs = [tuple(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d) for d in p) for p in pairs]
    if not pairs:
        return spark.createDataFrame([], "day_a date, day_b date, shared_ids long")
    days = sorted({d for p in pairs for d in p})
    place = {d: i for i, d in enumerate(days)}
    at = (F.array_position(F.array(*[F.lit(d) for d in days]), F.col("event_date")) - 1).cast("int")
    own = events.where(F.col("event_id").isNotNull() & F.col("event_date").isin(days)).select("event_id", at.alias("at"))
    words = range(len(days) // 64 + 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)
    ids = own.groupBy("event_id").agg(*[F.bit_or(F.when(F.expr(f"at div 64 = {w}"), bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words])
    many = sum((F.bit_count(f"w{w}") for w in words), F.lit(0)) > 1
    # One struct a pair: word and bit of both days, and the pair's number.
    listed = F.from_json(F.lit(json.dumps([[place[a] // 64, place[a] % 64, place[b] // 64, place[b] % 64, k]
                                           for k, (a, b) in enumerate(dict.fromkeys(pairs))])), "array<array<int>>")
    on = lambda w, b: F.call_function("shiftright", F.element_at("words", w + 1), b).bitwiseAND(F.lit(1)) == 1
    shared = (ids.where(many).select(F.array(*[f"w{w}" for w in words]).alias("words"))
              .select(F.explode(F.filter(listed, lambda p: on(p[0], p[1]) & on(p[2], p[3]))).alias("p"))
              .groupBy(F.col("p")[4].alias("k")).agg(F.count(F.lit(1)).alias("n")))
    numbered = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(dict.fromkeys(pairs))], "k int, day_a date, day_b date")
    return numbered.join(shared, "k", "left").select("day_a", "day_b", F.coalesce("n", F.lit(0)).cast("long").alias("shared_ids"))


# -------------------------------------------------------------------- J1
def key_counts(events: DataFrame) -> DataFrame:
    """One row ``n, pairs, ids``: rows, distinct ``(event_id, event_date)`` and distinct
    ids, NULL keys not counted. Grouped by the pair, then by the id, each combined
    map-side first: no Expand multiplies the rows, and a repeated key is one row a task."""
    both = F.col("event_id").isNotNull() & F.col("event_date").isNotNull()
    pairs = events.groupBy("event_id", "event_date").agg(F.count(F.lit(1)).alias("n"))
    ids = pairs.groupBy("event_id").agg(F.sum("n").alias("n"), F.count_if(both).alias("pairs"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return ids.agg(total("n").alias("n"), total("pairs").alias("pairs"), F.count("event_id").alias("ids"))


def unique_per_day(events: DataFrame) -> DataFrame:
    """``(event_id, event_date)`` unique; informative global id reuse."""
    a = key_counts(events)
    return _rows(a, [
        _row("event_id unique within its day", F.col("n") == F.col("pairs"),
             F.col("n") - F.col("pairs"), 0,
             F.format_string("%d rows, %d distinct (id, date)", "n", "pairs")),
        _row("info: ids reused across dates", F.lit(True), F.col("n") - F.col("ids"), 0,
             F.format_string("%d distinct ids over %d rows", "ids", "n")),
    ])


# -------------------------------------------------------------------- J2
def time_range(events: DataFrame, lo: str, hi: str) -> DataFrame:
    """Instants inside ``[lo, hi]`` and the first instant at midnight UTC.

    Formatting happens in Spark (session zone UTC), never in the driver.
    """
    a = events.agg(F.date_format(F.min("created_ts"), "yyyy-MM-dd HH:mm:ss").alias("mn"),
                   F.date_format(F.max("created_ts"), "yyyy-MM-dd HH:mm:ss").alias("mx"))
    return _rows(a, [
        _row("created_ts >= window start", F.substring("mn", 1, 10) >= F.lit(lo),
             F.unix_timestamp(F.col("mn")), F.unix_timestamp(F.lit(f"{lo} 00:00:00")),
             F.concat(F.lit("min "), F.col("mn"))),
        _row("created_ts <= window end", F.substring("mx", 1, 10) <= F.lit(hi),
             F.unix_timestamp(F.col("mx")), F.unix_timestamp(F.lit(f"{hi} 23:59:59")),
             F.concat(F.lit("max "), F.col("mx"))),
        _row("first instant is midnight UTC", F.substring("mn", 12, 8) == F.lit("00:00:00"),
             F.unix_timestamp(F.col("mn")) % 86400, 0,
             F.concat(F.lit("starts at "), F.substring("mn", 12, 8))),
    ])


# -------------------------------------------------------------------- J3
def hours_per_day(events: DataFrame) -> DataFrame:
    """Per day: distinct UTC hours with events."""
    return (events.groupBy("event_date")
            .agg(F.countDistinct(F.hour("created_ts")).alias("hours")))


def days_missing_hours(events: DataFrame) -> DataFrame:
    """Every day with fewer than 24 hours, as rows."""
    return hours_per_day(events).where(F.col("hours") < 24)


def hours_covered(events: DataFrame) -> DataFrame:
    """Every day has all 24 hours (:func:`days_missing_hours` lists those that don't)."""
    a = days_missing_hours(events).agg(F.count(F.lit(1)).alias("n"))
    return a.select(*_row("every day has 24 hours", F.col("n") == 0, F.col("n"), 0))


# -------------------------------------------------------------------- J4-J7
def null_profile(events: DataFrame, pr_events: DataFrame | None = None,
                 mandatory: Iterable[str] = MANDATORY_COLUMNS,
                 rate_max: dict[str, float] = NULL_RATE_MAX_PCT,
                 full_cov: dict[str, float] = FULL_FORMAT_MIN_COVERAGE_PCT) -> DataFrame:
    """J4 (zero NULLs), J5 (NULL-rate ceilings), J6 (full-format coverage
    floors) and J7 (``pr_id``/``is_merge`` never NULL), one pass per table."""
    mandatory = list(mandatory)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in mandatory]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"r_{c}") for c in rate_max]
    ev = events.agg(*aggs)
    ev_rows = [_row(f"{c} has no NULLs", F.col(f"n_{c}") == 0, F.col(f"n_{c}"), 0) for c in mandatory]
    for c, mx in rate_max.items():
        pct = F.when(F.col("_n") > 0, F.lit(100.0) * F.col(f"r_{c}") / F.col("_n")).otherwise(F.lit(0.0))
        ev_rows.append(_row(f"{c} NULL rate <= {mx}%", pct <= F.lit(mx), F.round(pct, 6), mx))
    frames = [_rows(ev, ev_rows)]
    if pr_events is not None:
        is_full = F.col("payload_format") == F.lit(FULL)
        pa = [F.count_if(is_full).alias("_full"),
              F.count_if(F.col("pr_id").isNull()).alias("_pr_null"),
              F.count_if(F.col("is_merge").isNull()).alias("_merge_null")]
        pa += [F.count_if(is_full & F.col(c).isNotNull()).alias(f"c_{c}") for c in full_cov]
        pr = pr_events.agg(*pa)
        pr_rows = []
        for c, mn in full_cov.items():
            cov = F.when(F.col("_full") > 0, F.lit(100.0) * F.col(f"c_{c}") / F.col("_full"))
            pr_rows.append(_row(
                f"{c} coverage >= {mn}% on full format",
                F.when(F.col("_full") == 0, F.lit(True)).otherwise(cov >= F.lit(mn)),
                F.round(cov, 6), mn,
                F.when(F.col("_full") == 0, F.lit("skipped: no full-format rows"))))
        pr_rows.append(_row("pr_id has no NULLs in any format", F.col("_pr_null") == 0, F.col("_pr_null"), 0))
        pr_rows.append(_row("is_merge has no NULLs", F.col("_merge_null") == 0, F.col("_merge_null"), 0))
        frames.append(_rows(pr, pr_rows))
    return _union(frames)


# -------------------------------------------------------------------- J8-J9
def reconcile_days(bronze: DataFrame, silver_events: DataFrame) -> DataFrame:
    """C4: per-day bronze vs silver counts (full outer join, NULL -> 0).

    ``bronze_keys`` (distinct non-NULL ``(id, date)``) is the exact expectation;
    ``bronze_rows`` the cheap tolerance-mode one.
    """
    b = (bronze.groupBy("event_date")
         .agg(F.count(F.lit(1)).alias("bronze_rows"),
              F.count_distinct(F.expr("try_cast(id AS BIGINT)")).alias("bronze_keys")))
    s = silver_events.groupBy("event_date").agg(F.count(F.lit(1)).alias("silver_rows"))
    return (b.join(s, "event_date", "full_outer")
            .fillna(0, ["bronze_rows", "bronze_keys", "silver_rows"])
            .withColumn("missing_rows", F.col("bronze_rows") - F.col("silver_rows"))
            .withColumn("missing_keys", F.col("bronze_keys") - F.col("silver_rows"))
            .withColumn("flag_tolerance",
                        F.col("missing_rows") > F.col("bronze_rows") * F.lit(RECONCILE_TOLERANCE))
            .withColumn("flag_exact", F.col("missing_keys") != 0))


def reconcile(bronze: DataFrame, silver_events: DataFrame, mode: str | Sequence[str] = "exact",
              tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """J8 (no day loses rows; :func:`worst_days` lists them) and J9 (total loss), for
    one mode or several; all modes come from one per-day table and one
    aggregate over it (the bronze and silver scans run once)."""
    modes = (mode,) if isinstance(mode, str) else tuple(mode)
    days = reconcile_days(bronze, silver_events)
    aggs, rows = [F.sum("silver_rows").alias("ts")], []
    for m in modes:
        exp = F.col("bronze_keys" if m == "exact" else "bronze_rows")
        d = exp - F.col("silver_rows")
        flagged = (d != 0) if m == "exact" else (d > exp * F.lit(tolerance))
        aggs += [F.count_if(flagged).alias(f"bad_{m}"), F.sum(exp).alias(f"tb_{m}")]
        tb = F.coalesce(F.col(f"tb_{m}"), F.lit(0))
        loss = tb - F.coalesce(F.col("ts"), F.lit(0))
        limit = F.coalesce(F.col(f"tb_{m}"), F.lit(1)) * F.lit(tolerance)
        rows += [
            _row(f"no day loses rows vs bronze ({m})", F.col(f"bad_{m}") == 0, F.col(f"bad_{m}"), 0),
            _row(f"total loss within tolerance ({m})",
                 (loss == 0) if m == "exact" else (F.abs(loss) <= limit), loss, limit,
                 F.format_string("%d rows of difference over %d", loss, tb)),
        ]
    return _rows(days.agg(*aggs), rows)


def worst_days(bronze: DataFrame, silver_events: DataFrame, mode: str = "exact", k: int = 3) -> DataFrame:
    """The k flagged days with the largest difference (ties to the earlier day)."""
    days = reconcile_days(bronze, silver_events).where(f"flag_{mode}")
    gap = F.abs(F.col("missing_keys" if mode == "exact" else "missing_rows"))
    return (days.select("event_date", "bronze_rows", "bronze_keys", "silver_rows", gap.alias("difference"))
            .orderBy(F.desc("difference"), "event_date").limit(k))


def parseable(bronze: DataFrame, max_pct: float = UNPARSEABLE_MAX_PCT) -> DataFrame:
    """Lines without a numeric event id: silver can't hold them and the exact
    reconciliation doesn't count them, so their number and rate are checks of their own."""
    bad = F.expr("try_cast(id AS BIGINT)").isNull()
    a = bronze.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    pct = F.when(F.col("n") > 0, F.lit(100.0) * F.col("bad") / F.col("n")).otherwise(F.lit(0.0))
    return _rows(a, [_row("info: lines without an event id", F.lit(True), F.col("bad"), 0),
                     _row("lines without an event id are rare", pct <= F.lit(max_pct), F.round(pct, 6), max_pct)])


# -------------------------------------------------------------------- J10-J14
def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Groups of ``cols`` that occur more than once (zero rows = pass)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def unique_check(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """J10/J11 as a check row. A single column is checked on non-NULL values."""
    src = df.where(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    v = unique_combination(src, cols).agg(F.count(F.lit(1)).alias("v"))
    return v.select(*_row(f"{name} unique on ({', '.join(cols)})", F.col("v") == 0, F.col("v"), 0))


def not_null_check(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Declared not-null columns, one pass."""
    a = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _rows(a, [_row(f"{name}.{c} not null", F.col(c) == 0, F.col(c), 0) for c in cols])


def accepted_values_check(df: DataFrame, col: str, values: Sequence, name: str) -> DataFrame:
    """Values outside the accepted set (NULL passes, as declared tests do)."""
    a = df.agg(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).alias("v"))
    return a.select(*_row(f"{name}.{col} accepted values", F.col("v") == 0, F.col("v"), 0))


def declared_checks(df: DataFrame, not_null: Sequence[str], accepted: Sequence[tuple[str, Sequence]], name: str) -> DataFrame:
    """J12 and J13 of one table in one aggregate."""
    nulls = {f"{name}.{c} not null": F.col(c).isNull() for c in not_null}
    strange = {f"{name}.{c} accepted values": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in accepted}
    checks = {**nulls, **strange}
    a = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
    return _rows(a, [_row(n, F.col(f"c{i}") == 0, F.col(f"c{i}"), 0) for i, n in enumerate(checks)])


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (anti join)."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return (child.where(F.col(fk).isNotNull())
            .join(p, F.col(fk) == F.col("_pk"), "left_anti"))


def relationship_check(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """J14 as a check row."""
    v = orphans(child, fk, parent, pk).agg(F.count(F.lit(1)).alias("v"))
    return v.select(*_row(f"{name}: {fk} references parent.{pk}", F.col("v") == 0, F.col("v"), 0))


# -------------------------------------------------------------------- report
def quality_report(*parts: DataFrame) -> DataFrame:
    return _union(list(parts))


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> list:
    """Run the report (the only action) and raise if any check failed.

    The report has one row per check, so collecting it is bounded.
    """
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        msg = "; ".join(f"{r['check']}: observed {r['observed']} ({r['detail']})" for r in failed)
        raise QualityGateError(f"{len(failed)} of {len(rows)} checks failed: {msg}")
    return rows
