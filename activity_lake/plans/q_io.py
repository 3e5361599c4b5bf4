"""Registered queries that write and read files.

Each call writes under a fresh folder of the shared checkpoint directory
(``spark.checkpoint.dir``), then returns a DataFrame over what was read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import bronze as B
from ..operators import reports as R
from ..schemas import EVENTS, PR_EVENTS
from ..session import configure, shared_dir
from ..sources import raw as RAW
from ..sources import sinks as SK
from ..streaming import incremental as INC
from . import adapters as A
from .oracle import q
from .output import for_output
from .pipeline import Lake
from .registry import register


def _scratch(spark, tag: str) -> str:
    return shared_dir(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


@register("raw_file_scan", q("E", """
    SELECT event_date, count(*) AS rows, count(DISTINCT hour(created_ts)) AS hours,
           count(DISTINCT event_id) AS ids
    FROM e_typed GROUP BY event_date"""), ops="A1 A2 A5 A6")
def raw_file_scan(spark, sf_dir):
    """Write the feed as hourly .gz files, scan them back (date and hour taken
    from the file path), extract bronze, count per day."""
    configure(spark)
    path = Lake(spark, sf_dir).raw_files()
    br = B.to_bronze(RAW.scan_raw(spark, path))
    return (br.groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.countDistinct(F.hour(F.expr("try_to_timestamp(created_at)"))).alias("hours"),
                 F.countDistinct("id").alias("ids")))


@register("write_roundtrip", q("E", """
    SELECT event_date, count(*) AS rows FROM e_events GROUP BY event_date"""),
    ops="A3 A4 A8 A11 A17 A5 A6")
def write_roundtrip(spark, sf_dir):
    """Silver written partitioned by day (zstd, dynamic overwrite), one day
    rewritten alone (its siblings must survive), then read back per day."""
    configure(spark)
    base = _scratch(spark, "roundtrip")
    ev = Lake(spark, sf_dir).stream_events()
    path = f"{base}/silver/events"
    res = SK.write_partitioned(ev, path, rebalance=True)
    if res["written"] != res["read_back"]:
        raise RuntimeError(f"read-back mismatch: {res}")
    first = SK.read_layer(spark, path).agg(F.min("event_date")).first()[0]
    SK.write_partitioned(ev.where(F.col("event_date") == F.lit(first)), path)
    return SK.per_day_counts(spark, path)


@register("file_inventory", q("E", f"""
    SELECT CAST(t AS DATE) AS file_date, CAST(hour(t) AS INTEGER) AS file_hour,
           if((CAST(t AS DATE), hour(t)) IN (SELECT DISTINCT event_date, hour(created_ts) FROM e_typed), 'ok', 'absent') AS state
    FROM (SELECT unnest(generate_series(TIMESTAMP '{A.EVENT_WINDOW[0]} 00:00:00', TIMESTAMP '{A.EVENT_WINDOW[1]} 23:00:00', INTERVAL 1 HOUR)) AS t)
    """), ops="A14")
def file_inventory(spark, sf_dir):
    """State of every hour of the window (ok, empty or absent), from the file listing."""
    configure(spark)
    path = Lake(spark, sf_dir).raw_files()
    return RAW.hour_states(spark, path, *A.EVENT_WINDOW)


@register("storage_report", q("E", """
    SELECT event_date, count(DISTINCT hour(created_ts)) AS hours_in, true AS has_bytes_in, true AS has_bytes_out
    FROM e_typed GROUP BY event_date"""), ops="A15")
def storage_report(spark, sf_dir):
    """Bytes in (gzip raw files) vs bytes out (bronze Parquet) per day, from listings;
    sizes depend on the codec, so the registered columns are those that don't."""
    configure(spark)
    base = _scratch(spark, "storage")
    path = Lake(spark, sf_dir).raw_files()
    SK.write_partitioned(B.retain_payload(B.to_bronze(RAW.scan_raw(spark, path))), f"{base}/bronze")
    rep = RAW.storage_report(spark, path, f"{base}/bronze")
    return rep.select("event_date", "hours_in", (F.col("bytes_in") > 0).alias("has_bytes_in"),
                      (F.col("bytes_out") > 0).alias("has_bytes_out"))


@register("run_log", q("E", """
    SELECT 'silver_events' AS layer, event_date, count(*) AS rows, true AS has_bytes FROM e_events GROUP BY event_date"""),
    ops="A12 A13")
def run_log(spark, sf_dir):
    """One log record per written day, appended as JSON next to a corrupt line;
    the tolerant reader drops the corrupt line."""
    configure(spark)
    base = _scratch(spark, "runlog")
    ev = Lake(spark, sf_dir).stream_events()
    res = SK.write_partitioned(ev, f"{base}/silver/events", rebalance=True)
    per_day = SK.per_day_counts(spark, f"{base}/silver/events")
    sizes = RAW.layer_bytes(spark, f"{base}/silver/events")
    SK.append_run_log(spark, SK.log_records(per_day, "silver_events", res["seconds"], bytes_out=sizes), f"{base}/log")
    (spark.createDataFrame([('{"layer": "silver_events", "rows": ',)], "value string")
     .write.mode("append").text(f"{base}/log"))
    log = SK.read_run_log(spark, f"{base}/log")
    return log.where(F.col("layer").isNotNull() & F.col("event_date").isNotNull()).select(
        "layer", "event_date", "rows", (F.col("bytes_out") > 0).alias("has_bytes"))


_EXPORT_CTE = {"monthly_activity": "activity", "monthly_language": "lang", "monthly_ai_agents": "agents",
               "monthly_latency": "latency", "censoring_matrix": "censor", "retention_curve": "retention",
               "repo_balance": "balance", "calendar_export": "dim_date"}


# Each export's report and the gold table that it reads.
_EXPORTS = {"monthly_activity": (R.monthly_activity, "fact_pr_event"), "monthly_language": (R.monthly_language, "fact_pr_event"),
            "monthly_ai_agents": (R.monthly_ai_agents, "fact_pr_event"), "monthly_latency": (R.monthly_latency, "pr_lifecycle"),
            "censoring_matrix": (R.censoring_matrix, "pr_lifecycle"), "retention_curve": (R.retention_curve, "contributor_month"),
            "repo_balance": (R.repo_balance, "contributor_month"), "calendar_export": (R.calendar_export, "dim_date")}


def _named_exports(lake, names=tuple(_EXPORTS)) -> dict:
    """The named aggregates over the stored gold tables; a gold table that none of them reads isn't built."""
    return {n: report(lake.gold(table)) for n, (report, table) in _EXPORTS.items() if n in names}


def _guard_sql(over: str) -> str:
    return q(tuple(_EXPORT_CTE.values()), "\nUNION ALL\n".join(
        f"SELECT '{n}' AS name, count(*) AS rows, {over} AS over_limit FROM {c}" for n, c in _EXPORT_CTE.items()))


@register("export_guard", _guard_sql("false"), ops="A8 A9 A10 A16 G1")
def export_guard(spark, sf_dir):
    """Export the eight aggregates (zstd Parquet), re-read and count each, and
    flag any above the size guard."""
    report = SK.export_all(spark, _scratch(spark, "exports"), _named_exports(Lake(spark, sf_dir)))
    return report.select("name", "rows", "over_limit")


@register("export_guard_over", _guard_sql("true"), ops="A16")
def export_guard_over(spark, sf_dir):
    """The same with a limit of one byte: every export is flagged."""
    report = SK.export_all(spark, _scratch(spark, "exports"), _named_exports(Lake(spark, sf_dir)), max_mb=1 / 2**20)
    return report.select("name", "rows", "over_limit")


def _export_values(name: str, columns: str, source: str):
    @register(f"export_{name}", q(source, f"SELECT {columns} FROM {source}"), ops="A8 A9 A10 G1")
    def read_back(spark, sf_dir):
        out = _scratch(spark, "export")
        SK.export_all(spark, out, _named_exports(Lake(spark, sf_dir), [name]))
        return SK.read_exports(spark, out, [name])[name]
    read_back.__doc__ = f"Values of the {name} export, written from stored gold tables and read back."


for _name, _source in _EXPORT_CTE.items():
    _export_values(_name, "date, year, month, source_format, is_known_gap, has_data" if _name == "calendar_export" else "*", _source)


def _waves(spark, feed, base: str, waves) -> None:
    """The raw files arrive wave by wave; the incremental job runs after each."""
    for wave in waves:
        RAW.write_raw(feed.where(wave), f"{base}/raw", mode="append")
        INC.run_incremental(spark, f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/_ckpt")


@register("stream_equals_batch", q("E", "SELECT * FROM e_events"), ops="L1")
def stream_equals_batch(spark, sf_dir):
    """Files arrive in three waves (hours 8-15, 16-23, then 0-7, so every day gets
    late hours); the incremental job runs after each wave. The silver it
    leaves must equal the one-shot batch silver."""
    configure(spark)
    base = _scratch(spark, "incremental")
    hour = F.col("file_hour")
    _waves(spark, Lake(spark, sf_dir).event_raw(), base, (hour.between(8, 15), hour >= 16, hour < 8))
    return for_output(SK.read_layer(spark, f"{base}/silver/events", EVENTS))


@register("stream_equals_batch_pr", q("P", """
    SELECT DISTINCT * REPLACE (DATE '1995-01-01' + CAST(date_diff('day', DATE '1970-01-01', event_date) % 31 AS INTEGER) AS event_date,
        strftime(created_ts, '%H:%M:%S') AS created_ts, strftime(review_submitted_ts, '%H:%M:%S') AS review_submitted_ts)
    FROM p_all"""), ops="L1")
def stream_equals_batch_pr(spark, sf_dir):
    """The second silver table through the incremental path: pull-request events of both
    payload formats. The feed comes as three files a month (its day of the path is the
    month's first), in three waves, each with a third of every month."""
    configure(spark)
    base = _scratch(spark, "incremental-pr")
    folded = F.expr("date_add(DATE'1995-01-01', cast(unix_date(to_date(file_date)) % 31 as int))")
    feed = A.pr_feed(spark, sf_dir).select("value", folded.cast("string").alias("file_date"),
                                           F.expr("cast(file_hour div 8 as int)").alias("file_hour"))
    _waves(spark, feed, base, [F.col("file_hour") == k for k in (1, 2, 0)])
    out = for_output(SK.read_layer(spark, f"{base}/silver/pr_events", PR_EVENTS))
    return out.withColumns({c: F.date_format(c, "HH:mm:ss") for c in ("created_ts", "review_submitted_ts")})


@register("stream_dedup", q("E", "SELECT * FROM e_events"), ops="L2")
def stream_dedup(spark, sf_dir):
    """In-stream dedup on ``(event_id, event_date)``; the files arrive in two waves, the
    second with the earlier hours of every day, so it is late by up to the whole feed."""
    configure(spark)
    base = _scratch(spark, "stream-dedup")
    feed = Lake(spark, sf_dir).event_raw()
    for wave in (F.col("file_hour") >= 12, F.col("file_hour") < 12):
        RAW.write_raw(feed.where(wave), f"{base}/raw", mode="append")
        INC.stream_dedup(spark, f"{base}/raw", f"{base}/out", f"{base}/_ckpt")
    return for_output(SK.read_layer(spark, f"{base}/out", EVENTS).drop("batch"))
