"""Feeds derived from the driver's tables (see FIXTURES.md section 3).

The test tables are not collaboration events, so these adapters *derive* an
ndjson event feed from them with Spark: every row of ``events``, ``orders`` and
``lineitem`` becomes one or more JSON lines, so the feed grows with the tables.
The rest of the pipeline then runs the real path: JSON text -> bronze ->
silver -> gold. The DuckDB oracle builds the same typed rows straight from the
tables (``plans/oracle.py``), so JSON extraction is checked independently.

Rules (all deterministic; the modulo rules *shape* the feed - duplicates, id
reuse, censored lifecycles - they never select a subset of the input):

Adapter E (``events``): every row, plus rows with ``event_id % 97 = 0`` repeated
byte-identically, plus rows with ``event_id % 89 = 0`` repeated with
``ts + 3 days`` and type ``reused`` (same id on another date).

Adapter P (``orders`` + ``lineitem``): per order an *opened* event (when
``o_orderkey % 11 <> 0``), an *end* event for status F (merge) or P (close),
and one review per lineitem row. Orders dated before 1999-01-01 emit the full
payload format, later ones the reduced format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import to_iso

# --- fixed values of the test feed ------------------------------------------
FORMAT_CHANGE_TS = "1999-01-01 00:00:00"      # first reduced-format instant
PR_WINDOW = ("1995-01-01", "2001-08-15")      # analysis window for adapter P
KNOWN_GAP = ("1999-01-01", "1999-01-06")      # known-gap days for calendar tests
EVENT_WINDOW = ("2024-01-01", "2024-02-29")   # analysis window for adapter E
# ----------------------------------------------------------------------------


def login_for(n: Column) -> Column:
    """Actor login for a numeric id: 0 AI agent, 1 dependency bot, 2 CI bot,
    3 unknown bot, otherwise a human ``user<n>``."""
    m = n % 10
    return (F.when(m == 0, F.lit("claude[bot]"))
            .when(m == 1, F.lit("dependabot[bot]"))
            .when(m == 2, F.lit("github-actions[bot]"))
            .when(m == 3, F.lit("misc-helper[bot]"))
            .otherwise(F.concat(F.lit("user"), n.cast("string"))))


def _raw(value: Column, ts: Column) -> list[Column]:
    return [value.alias("value"),
            F.date_format(ts, "yyyy-MM-dd").alias("file_date"),
            F.hour(ts).alias("file_hour")]


def _table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """One driver table, hash-partitioned by ``key`` if given: the order and line-item
    feeds meet on the order key, so this is the shuffle that their join needs anyway."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key) if key else df


# --------------------------------------------------------------- adapter E
def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed adapter-E rows before serialisation (``ts`` is TIMESTAMP_NTZ)."""
    ev = _table(spark, sf_dir, "events", "event_id").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    base = ev
    dup = ev.where(F.col("event_id") % 97 == 0)
    reused = (ev.where(F.col("event_id") % 89 == 0)
              .withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS"))
              .withColumn("event_type", F.lit("reused")))
    return base.unionByName(dup).unionByName(reused)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E as raw ndjson lines ``(value, file_date, file_hour)``."""
    ev = event_rows(spark, sf_dir).withColumn("ts", F.date_trunc("second", F.col("ts")))
    uid, eid = F.col("user_id"), F.col("event_id")
    doc = F.struct(
        eid.cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(uid.alias("id"), login_for(uid).alias("login")).alias("actor"),
        F.struct((uid % 7 * 100 + eid % 50).alias("id"),
                 F.concat(F.lit("org"), (uid % 7).cast("string"), F.lit("/repo"),
                          (eid % 50).cast("string")).alias("name")).alias("repo"),
        F.struct(F.from_json("props", "k BIGINT").alias("props"),
                 F.col("value").alias("value")).alias("payload"),
        F.lit(True).alias("public"),
        to_iso(F.col("ts")).alias("created_at"),
    )
    return ev.select(*_raw(F.to_json(doc), F.col("ts")))


# --------------------------------------------------------------- adapter P
def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders", "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return (o
            .withColumn("opened_ts", F.col("o_orderdate")
                        + F.make_dt_interval(F.lit(0), F.lit(0), k % 1440, k % 60))
            .withColumn("end_ts", F.col("opened_ts")
                        + F.make_dt_interval(F.lit(0), c % 400, F.lit(0), c % 97))
            .withColumn("full_fmt", F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ'{FORMAT_CHANGE_TS}'"))
            .withColumn("repo", F.concat(F.lit("org"), (k % 7).cast("string"),
                                         F.lit("/repo"), (k % 50).cast("string")))
            .withColumn("author", login_for(c))
            .withColumn("language", F.when(k % 12 != 0,
                                           F.concat(F.lit("lang"), (k % 6).cast("string")))))


def _pr_doc(event_id: Column, etype: str, ts: Column, actor: Column, action: Column,
            full: Column, *, merged: Column | None = None, merged_ts: Column | None = None,
            closed_ts: Column | None = None, review: Column | None = None) -> Column:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    author = F.col("author")

    def full_only(x: Column) -> Column:
        return F.when(full, x)

    pr = F.struct(
        k.alias("id"), k.alias("number"),
        full_only(to_iso(F.col("opened_ts"))).alias("created_at"),
        full_only(to_iso(merged_ts) if merged_ts is not None else F.lit(None).cast("string")).alias("merged_at"),
        full_only(to_iso(closed_ts) if closed_ts is not None else F.lit(None).cast("string")).alias("closed_at"),
        full_only(merged if merged is not None else F.lit(None).cast("boolean")).alias("merged"),
        full_only(F.struct(author.alias("login"),
                           F.when(author.endswith("[bot]"), F.lit("Bot")).otherwise(F.lit("User")).alias("type"))
                  ).alias("user"),
        full_only(c % 500).alias("additions"),
        full_only(k % 300).alias("deletions"),
        F.struct(F.struct(full_only(F.col("language")).alias("language")).alias("repo")).alias("base"),
    )
    payload = F.struct(action.alias("action"), k.alias("number"), pr.alias("pull_request"),
                       (review if review is not None else F.lit(None).cast(
                           "struct<state:string,submitted_at:string>")).alias("review"))
    return F.struct(
        event_id.cast("string").alias("id"),
        F.lit(etype).alias("type"),
        F.struct((F.abs(F.xxhash64(actor)) % 1000000).alias("id"), actor.alias("login")).alias("actor"),
        F.struct((k % 7 * 100 + k % 50).alias("id"), F.col("repo").alias("name")).alias("repo"),
        payload.alias("payload"),
        F.lit(True).alias("public"),
        to_iso(ts).alias("created_at"),
    )


def pr_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter P as raw ndjson lines ``(value, file_date, file_hour)``."""
    o = _orders(spark, sf_dir)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    full = F.col("full_fmt")
    status = F.col("o_orderstatus")

    opened = (o.where(k % 11 != 0)
              .select(*_raw(F.to_json(_pr_doc(k * 100, "PullRequestEvent", F.col("opened_ts"),
                                              F.col("author"), F.lit("opened"), full)),
                            F.col("opened_ts"))))

    is_f = status == F.lit("F")
    end_actor = F.concat(F.lit("user"), (c % 13).cast("string"))
    end_action = F.when(is_f & ~full, F.lit("merged")).otherwise(F.lit("closed"))
    ended = (o.where(status.isin("F", "P"))
             .select(*_raw(F.to_json(_pr_doc(
                 k * 100 + 1, "PullRequestEvent", F.col("end_ts"), end_actor, end_action, full,
                 merged=is_f, merged_ts=F.when(is_f, F.col("end_ts")), closed_ts=F.col("end_ts"))),
                 F.col("end_ts"))))

    li = _table(spark, sf_dir, "lineitem", "l_orderkey").select("l_orderkey", "l_linenumber", "l_shipdate")
    s = F.col("l_orderkey") + F.col("l_linenumber")
    rv = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
          .withColumn("review_ts", F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), s % 1440, F.lit(0)))
          .withColumn("reviewer", F.when(s % 5 == 0, F.lit("coderabbitai[bot]"))
                      .otherwise(F.concat(F.lit("user"), (s % 300).cast("string"))))
          .withColumn("review_state", F.when(s % 3 == 0, F.lit("approved"))
                      .when(s % 3 == 1, F.lit("commented")).otherwise(F.lit("changes_requested"))))
    review = F.struct(F.col("review_state").alias("state"), to_iso(F.col("review_ts")).alias("submitted_at"))
    reviews = rv.select(*_raw(F.to_json(_pr_doc(
        F.col("l_orderkey") * 100 + 10 + F.col("l_linenumber"), "PullRequestReviewEvent",
        F.col("review_ts"), F.col("reviewer"), F.lit("created"), full, review=review)),
        F.col("review_ts")))
    return opened.unionByName(ended).unionByName(reviews)


def pr_push_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Push events for the truncation profile: ``size = o_orderkey % 30`` and a
    ``commits`` array of ``min(size, 20)`` entries (the feed caps arrays at 20)."""
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    size = (k % 30).cast("int")
    commits = F.transform(F.sequence(F.lit(1), F.least(size, F.lit(20))),
                          lambda i: F.struct(F.concat(F.lit("c"), k.cast("string"), F.lit("-"),
                                                      i.cast("string")).alias("sha")))
    commits = F.when(size > 0, commits).otherwise(F.array().cast("array<struct<sha:string>>"))
    doc = F.struct(
        (k * 100 + 2).cast("string").alias("id"),
        F.lit("PushEvent").alias("type"),
        F.struct(F.col("author").alias("login")).alias("actor"),
        F.struct(F.col("repo").alias("name")).alias("repo"),
        F.struct(F.concat(F.lit("refs/heads/b"), (k % 4).cast("string")).alias("ref"),
                 F.when(F.col("full_fmt"), size).alias("size"),
                 F.when(F.col("full_fmt"), commits).alias("commits")).alias("payload"),
        to_iso(F.col("opened_ts")).alias("created_at"),
    )
    return o.select(*_raw(F.to_json(doc), F.col("opened_ts")))


MALFORMED_LINES = ("this is not json", "{broken", "")


def profile_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter P + push events + adapter E + a few malformed lines: the mixed
    feed the profiling operators run on (both payload formats present)."""
    bad = (_table(spark, sf_dir, "region").select("r_regionkey")
           .select(F.element_at(F.array(*[F.lit(x) for x in MALFORMED_LINES]),
                                (F.col("r_regionkey") % len(MALFORMED_LINES) + 1).cast("int")).alias("value"),
                   F.lit("1995-01-01").alias("file_date"), F.lit(0).alias("file_hour")))
    return (pr_feed(spark, sf_dir)
            .unionByName(pr_push_feed(spark, sf_dir))
            .unionByName(event_feed(spark, sf_dir))
            .unionByName(bad))
