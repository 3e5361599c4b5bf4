"""Registered queries: data-quality checks."""

from __future__ import annotations

from ..functions.actors import ACTOR_CLASSES
from ..operators import bronze as B
from ..operators import quality as Q
from ..operators import silver as S
from . import adapters as A
from .oracle import q
from .pipeline import Lake
from .registry import register

_OUT = ["check", "passed", "observed", "threshold"]
E_LO, E_HI = A.EVENT_WINDOW


def _checks(df):
    return df.select(*_OUT)


def _sql_row(check: str, passed: str, observed: str, threshold: str, src: str) -> str:
    return (f"SELECT '{check}' AS \"check\", ({passed}) AS passed, CAST({observed} AS DOUBLE) AS observed, "
            f"CAST({threshold} AS DOUBLE) AS threshold FROM {src}")


def _union_sql(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


def _stream_events(lake):
    return S.stage(lake.stream_events(), E_LO, E_HI)


# -------------------------------------------------------------------- J1
@register("q_unique_per_day", q("E", _union_sql([
    _sql_row("event_id unique within its day", "count(*) = count(DISTINCT (event_id, event_date))",
             "count(*) - count(DISTINCT (event_id, event_date))", "0", "e_events"),
    _sql_row("info: ids reused across dates", "true", "count(*) - count(DISTINCT event_id)", "0", "e_events"),
])), ops="J1 H1")
def q_unique_per_day(spark, sf_dir):
    return _checks(Q.unique_per_day(_stream_events(Lake(spark, sf_dir))))


# -------------------------------------------------------------------- J2
_TR = "(SELECT min(created_ts) AS mn, max(created_ts) AS mx FROM e_events) a"


@register("q_time_range", q("E", _union_sql([
    _sql_row("created_ts >= window start", f"CAST(mn AS DATE) >= DATE '{E_LO}'", "epoch(mn)",
             f"epoch(TIMESTAMP '{E_LO} 00:00:00')", _TR),
    _sql_row("created_ts <= window end", f"CAST(mx AS DATE) <= DATE '{E_HI}'", "epoch(mx)",
             f"epoch(TIMESTAMP '{E_HI} 23:59:59')", _TR),
    _sql_row("first instant is midnight UTC", "strftime(mn, '%H:%M:%S') = '00:00:00'",
             "CAST(epoch(mn) AS BIGINT) % 86400", "0", _TR),
])), ops="J2")
def q_time_range(spark, sf_dir):
    return _checks(Q.time_range(_stream_events(Lake(spark, sf_dir)), E_LO, E_HI))


# -------------------------------------------------------------------- J3
_HOURS = "(SELECT event_date, count(DISTINCT hour(created_ts)) AS hours FROM e_events GROUP BY 1)"


@register("q_hours_per_day", q("E", f"SELECT * FROM {_HOURS} h"), ops="J3")
def q_hours_per_day(spark, sf_dir):
    return Q.hours_per_day(_stream_events(Lake(spark, sf_dir)))


@register("q_hours_covered", q("E", _sql_row(
    "every day has 24 hours", "count(*) FILTER (WHERE hours < 24) = 0",
    "count(*) FILTER (WHERE hours < 24)", "0", f"{_HOURS} h")), ops="J3")
def q_hours_covered(spark, sf_dir):
    return _checks(Q.hours_covered(_stream_events(Lake(spark, sf_dir))))


@register("q_days_missing_hours", q("E", f"SELECT * FROM {_HOURS} h WHERE hours < 24"), ops="J3")
def q_days_missing_hours(spark, sf_dir):
    """Every failing day of J3."""
    return Q.days_missing_hours(_stream_events(Lake(spark, sf_dir)))


# -------------------------------------------------------------------- J4-J7
def _null_profile_sql() -> str:
    rows = [_sql_row(f"{c} has no NULLs", f"count(*) FILTER (WHERE {c} IS NULL) = 0",
                     f"count(*) FILTER (WHERE {c} IS NULL)", "0", "e_events")
            for c in Q.MANDATORY_COLUMNS]
    for c, mx in Q.NULL_RATE_MAX_PCT.items():
        pct = f"CASE WHEN count(*) > 0 THEN 100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) ELSE 0.0 END"
        rows.append(_sql_row(f"{c} NULL rate <= {mx}%", f"{pct} <= {mx}", f"round({pct}, 6)", str(mx), "e_events"))
    full = "count(*) FILTER (WHERE payload_format = 'full')"
    for c, mn in Q.FULL_FORMAT_MIN_COVERAGE_PCT.items():
        cov = (f"CASE WHEN {full} > 0 THEN 100.0 * count(*) FILTER (WHERE payload_format = 'full' "
               f"AND {c} IS NOT NULL) / {full} END")
        rows.append(_sql_row(f"{c} coverage >= {mn}% on full format",
                             f"CASE WHEN {full} = 0 THEN true ELSE {cov} >= {mn} END",
                             f"round({cov}, 6)", str(mn), "pr_events"))
    rows.append(_sql_row("pr_id has no NULLs in any format", "count(*) FILTER (WHERE pr_id IS NULL) = 0",
                         "count(*) FILTER (WHERE pr_id IS NULL)", "0", "pr_events"))
    rows.append(_sql_row("is_merge has no NULLs", "count(*) FILTER (WHERE is_merge IS NULL) = 0",
                         "count(*) FILTER (WHERE is_merge IS NULL)", "0", "pr_events"))
    return q(("E", "P"), _union_sql(rows))


@register("q_null_profile", _null_profile_sql(), ops="J4 J5 J6 J7")
def q_null_profile(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return _checks(Q.null_profile(_stream_events(lake), lake.pr_events()))


# -------------------------------------------------------------------- J8-J9, C4, G3
_RECON_DAYS = """recon AS (
    SELECT coalesce(b.event_date, s.event_date) AS event_date,
           coalesce(b.bronze_rows, 0) AS bronze_rows, coalesce(b.bronze_keys, 0) AS bronze_keys,
           coalesce(s.silver_rows, 0) AS silver_rows,
           coalesce(b.bronze_rows, 0) - coalesce(s.silver_rows, 0) AS missing_rows,
           coalesce(b.bronze_keys, 0) - coalesce(s.silver_rows, 0) AS missing_keys,
           coalesce(b.bronze_rows, 0) - coalesce(s.silver_rows, 0) > coalesce(b.bronze_rows, 0) * 0.001
               AS flag_tolerance,
           coalesce(b.bronze_keys, 0) - coalesce(s.silver_rows, 0) <> 0 AS flag_exact
    FROM (SELECT event_date, count(*) AS bronze_rows, count(DISTINCT event_id) AS bronze_keys
          FROM e_typed GROUP BY 1) b
    FULL OUTER JOIN (SELECT event_date, count(*) AS silver_rows FROM e_events GROUP BY 1) s
      ON s.event_date = b.event_date)"""


def _recon_inputs(lake):
    bronze = lake.event_bronze_stored()
    return bronze, lake.stream_events()


@register("q_reconcile", q("E", "SELECT * FROM recon", extra=[_RECON_DAYS]), ops="C4 J8")
def q_reconcile(spark, sf_dir):
    """Per-day bronze vs silver reconciliation, both modes flagged."""
    return Q.reconcile_days(*_recon_inputs(Lake(spark, sf_dir)))


def _recon_summary_sql() -> str:
    rows = []
    for mode, exp, flag in (("exact", "bronze_keys", "flag_exact"), ("tolerance", "bronze_rows", "flag_tolerance")):
        rows.append(_sql_row(f"no day loses rows vs bronze ({mode})", f"count(*) FILTER (WHERE {flag}) = 0",
                             f"count(*) FILTER (WHERE {flag})", "0", "recon"))
        loss = f"(sum({exp}) - sum(silver_rows))"
        passed = f"{loss} = 0" if mode == "exact" else f"abs({loss}) <= sum({exp}) * 0.001"
        rows.append(_sql_row(f"total loss within tolerance ({mode})", passed, loss,
                             f"sum({exp}) * 0.001", "recon"))
    return q("E", _union_sql(rows), extra=[_RECON_DAYS])


@register("q_reconcile_summary", _recon_summary_sql(), ops="J8 J9 G3")
def q_reconcile_summary(spark, sf_dir):
    bronze, silver = _recon_inputs(Lake(spark, sf_dir))
    return _checks(Q.reconcile(bronze, silver, ("exact", "tolerance")))


@register("q_worst_days", q("E", """
    SELECT event_date, bronze_rows, bronze_keys, silver_rows, abs(missing_rows) AS difference FROM recon
    WHERE flag_tolerance ORDER BY difference DESC, event_date LIMIT 3""", extra=[_RECON_DAYS]), ops="G3")
def q_worst_days(spark, sf_dir):
    """The three worst days of the tolerance mode (byte-identical copies count as lost)."""
    return Q.worst_days(*_recon_inputs(Lake(spark, sf_dir)), "tolerance")


@register("q_unparseable", q(("P", "E"), """
    SELECT check_name AS "check", passed, CAST(observed AS DOUBLE) AS observed, CAST(threshold AS DOUBLE) AS threshold FROM (
      SELECT 'info: lines without an event id' AS check_name, true AS passed, bad AS observed, 0 AS threshold FROM u
      UNION ALL SELECT 'lines without an event id are rare', 100.0 * bad / n <= 0.1, round(100.0 * bad / n, 6), 0.1 FROM u)""",
    extra=["""u AS (SELECT (SELECT count(*) FROM region) AS bad, (SELECT count(*) FROM region) + (SELECT count(*) FROM p_rows)
             + (SELECT count(*) FROM orders) + (SELECT count(*) FROM e_typed) AS n)"""]), ops="J8 J9")
def q_unparseable(spark, sf_dir):
    """Bronze lines of the mixed feed (malformed ones included) without an event id."""
    return _checks(Q.parseable(B.to_bronze(Lake(spark, sf_dir).profile_raw())))


# -------------------------------------------------------------------- J10-J11
# fixed values: the declared keys, mandatory columns, accepted values and relationships
_UNIQUE = (
    ("fact_pr_event", "fact", ("date", "event_id")),
    ("pr_lifecycle", "lifecycle", ("repo", "pr_id")),
    ("contributor_month", "contrib", ("month", "repo", "actor")),
    ("dim_date", "dim_date", ("date",)),
    ("dim_actor", "dim_actor", ("actor",)),
    ("dim_repo", "dim_repo", ("repo",)),
)


def _unique_sql() -> str:
    rows = []
    for name, cte, cols in _UNIQUE:
        c = ", ".join(cols)
        where = f" WHERE {cols[0]} IS NOT NULL" if len(cols) == 1 else ""
        src = f"(SELECT count(*) AS v FROM (SELECT {c} FROM {cte}{where} GROUP BY {c} HAVING count(*) > 1) x) u"
        rows.append(_sql_row(f"{name} unique on ({c})", "v = 0", "v", "0", src))
    return q(("fact", "lifecycle", "contrib", "dim_date", "dim_actor", "dim_repo"), _union_sql(rows))


def _gold(lake):
    """The stored gold tables and the staging views: a check scans what it names."""
    return {"fact": lake.gold("fact_pr_event"), "lifecycle": lake.gold("pr_lifecycle"),
            "contrib": lake.gold("contributor_month"), "dim_date": lake.gold("dim_date"),
            "dim_actor": lake.gold("dim_actor"), "dim_repo": lake.gold("dim_repo"),
            "stg_events": lake.stg_events(), "stg_pr": lake.stg_pr_events()}


@register("q_unique_combination", _unique_sql(), ops="J10 J11")
def q_unique_combination(spark, sf_dir):
    g = _gold(Lake(spark, sf_dir))
    return _checks(Q.quality_report(*[Q.unique_check(g[cte], list(cols), name)
                                      for name, cte, cols in _UNIQUE]))


# -------------------------------------------------------------------- J12-J13
_NOT_NULL = (
    ("dim_date", ("date", "is_known_gap")),
    ("dim_actor", ("actor", "actor_class", "cohort_month")),
    ("dim_repo", ("repo", "has_language")),
    ("fact", ("event_id", "date", "actor", "is_merge")),
    ("lifecycle", ("pr_id", "repo", "opening_observed", "mature_cohort")),
    ("contrib", ("month", "actor", "repo", "months_of_life")),
    ("stg_events", ("event_id", "event_date")),
    ("stg_pr", ("event_id", "pr_id")),
)
_ACCEPTED = (
    ("dim_date", "source_format", ("full", "reduced")),
    ("dim_actor", "actor_class", ACTOR_CLASSES),
    ("fact", "payload_format", ("full", "reduced")),
    ("stg_events", "actor_class", ACTOR_CLASSES),
    ("stg_pr", "payload_format", ("full", "reduced")),
)


def _declared_sql() -> str:
    rows = []
    for t, cols in _NOT_NULL:
        for c in cols:
            rows.append(_sql_row(f"{t}.{c} not null", f"count(*) FILTER (WHERE {c} IS NULL) = 0",
                                 f"count(*) FILTER (WHERE {c} IS NULL)", "0", t))
    for t, c, vals in _ACCEPTED:
        lst = ", ".join(f"'{v}'" for v in vals)
        bad = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst}))"
        rows.append(_sql_row(f"{t}.{c} accepted values", f"{bad} = 0", bad, "0", t))
    return q(("fact", "lifecycle", "contrib", "dim_date", "dim_actor", "dim_repo"), _union_sql(rows))


@register("q_declared", _declared_sql(), ops="J12 J13")
def q_declared(spark, sf_dir):
    g = _gold(Lake(spark, sf_dir))
    parts = [Q.declared_checks(g[t], cols, [(c, vals) for own, c, vals in _ACCEPTED if own == t], t) for t, cols in _NOT_NULL]
    return _checks(Q.quality_report(*parts))


# -------------------------------------------------------------------- J14, C5
_RELS = (
    ("fact", "date", "dim_date", "date"),
    ("fact", "actor", "dim_actor", "actor"),
    ("fact", "repo", "dim_repo", "repo"),
    ("lifecycle", "repo", "dim_repo", "repo"),
    ("contrib", "actor", "dim_actor", "actor"),
    ("contrib", "repo", "dim_repo", "repo"),
)


def _orphans_sql() -> str:
    rows = []
    for child, fk, parent, pk in _RELS:
        src = (f"(SELECT count(*) AS v FROM {child} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})) o")
        rows.append(_sql_row(f"{child}: {fk} references parent.{pk}", "v = 0", "v", "0", src))
    return q(("fact", "lifecycle", "contrib", "dim_date", "dim_actor", "dim_repo"), _union_sql(rows))


@register("q_orphans", _orphans_sql(), ops="C5 J14")
def q_orphans(spark, sf_dir):
    g = _gold(Lake(spark, sf_dir))
    return _checks(Q.quality_report(*[Q.relationship_check(g[c], fk, g[p], pk, c)
                                      for c, fk, p, pk in _RELS]))

