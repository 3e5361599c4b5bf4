"""Quality gate: clean data passes, each injected fault fails exactly its check."""
import pytest
from pyspark.sql import functions as F

from activity_lake.operators import bronze as B
from activity_lake.operators import quality as Q
from activity_lake.operators import silver as S
from conftest import pr_doc, raw_df


def _clean_day(spark, n=2000, day="2025-08-13"):
    # one event at midnight and at least one per hour (FIXTURES 3.3)
    lines = []
    for i in range(n):
        h, m = (i % 24), (i // 24) % 60
        lines.append((pr_doc(i + 1, created=f"{day}T{h:02d}:{m:02d}:00Z", pr_id=i + 1,
                             actor=f"user{i % 50}", repo=f"o/r{i % 9}"), day))
    return B.to_bronze(raw_df(spark, lines))


def _report(spark, bronze, events, pr, lo="2025-08-13", hi="2025-08-13", mode="exact"):
    return Q.quality_report(
        Q.unique_per_day(events), Q.time_range(events, lo, hi), Q.hours_covered(events),
        Q.null_profile(events, pr), Q.reconcile(bronze, events, mode), Q.parseable(bronze))


def _failed(report):
    return sorted(r["check"] for r in report.collect() if not r["passed"])


@pytest.fixture(scope="module")
def clean(spark):
    br = _clean_day(spark).cache()
    return br, S.to_events(br).cache(), S.to_pr_events(br).cache()


def test_clean_passes(spark, clean):
    br, ev, pr = clean
    rows = Q.gate(_report(spark, br, ev, pr))
    assert len(rows) >= 14


def test_drop_one_row_fails_reconcile(spark, clean):
    br, ev, pr = clean
    f = _failed(_report(spark, br, ev.where(F.col("event_id") != 5), pr))
    assert f == ["no day loses rows vs bronze (exact)", "total loss within tolerance (exact)"]
    with pytest.raises(Q.QualityGateError):
        Q.gate(_report(spark, br, ev.where(F.col("event_id") != 5), pr))


def test_tolerance_mode_thresholds(spark, clean):
    br, ev, pr = clean
    four = ev.where(~F.col("event_id").isin(1, 2, 3, 4))     # 0.2 % lost -> fails
    one = ev.where(F.col("event_id") != 1)                    # 0.05 % lost -> passes
    assert "no day loses rows vs bronze (tolerance)" in _failed(Q.reconcile(br, four, "tolerance"))
    assert _failed(Q.reconcile(br, one, "tolerance")) == []


def test_null_actor_fails_mandatory(spark, clean):
    br, ev, pr = clean
    bad = ev.withColumn("actor", F.when(F.col("event_id") == 3, None).otherwise(F.col("actor")))
    assert _failed(_report(spark, br, bad, pr)) == ["actor has no NULLs"]


def test_shifted_instants_fail_range(spark, clean):
    br, ev, pr = clean
    bad = ev.withColumn("created_ts", F.col("created_ts") + F.expr("INTERVAL 2 HOURS"))
    f = _failed(_report(spark, br, bad, pr))
    assert "created_ts <= window end" in f and "first instant is midnight UTC" in f


def test_repeated_key_fails_uniqueness(spark, clean):
    br, ev, pr = clean
    bad = ev.unionByName(ev.where(F.col("event_id") == 7))
    assert "event_id unique within its day" in _failed(_report(spark, br, bad, pr))
    assert Q.unique_combination(bad, ["event_id", "event_date"]).count() == 1


def test_unlisted_class_orphan_and_null_merge(spark, clean):
    br, ev, pr = clean
    bad = ev.withColumn("actor_class", F.when(F.col("event_id") == 2, "alien").otherwise(F.col("actor_class")))
    assert Q.accepted_values_check(bad, "actor_class", ["human"], "t").first()["passed"] is False
    parent = ev.select("repo").distinct().where(F.col("repo") != "o/r1")
    assert Q.relationship_check(ev, "repo", parent, "repo", "t").first()["passed"] is False
    pr_bad = pr.withColumn("is_merge", F.when(F.col("event_id") == 9, None).otherwise(F.col("is_merge")))
    assert _failed(_report(spark, br, ev, pr_bad)) == ["is_merge has no NULLs"]


def test_garbage_lines_fail_the_gate(spark):
    day = "2025-08-13"
    br = B.to_bronze(raw_df(spark, [(pr_doc(i + 1), day) for i in range(10)] + [("garbage", day)] * 90))
    rows = {r["check"]: r for r in Q.parseable(br).collect()}
    assert rows["info: lines without an event id"]["observed"] == 90
    assert not rows["lines without an event id are rare"]["passed"]
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.quality_report(Q.reconcile(br, S.to_events(br)), Q.parseable(br)))


def test_unknown_class_reaches_the_dimension(spark, clean):
    from activity_lake.operators import dims
    bad = clean[1].withColumn("actor_class", F.when(F.col("actor") == "user1", "zombie").otherwise(F.col("actor_class")))
    assert Q.accepted_values_check(dims.dim_actor(bad), "actor_class", ["human"], "t").first()["passed"] is False
