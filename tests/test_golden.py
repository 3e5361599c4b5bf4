"""Golden hand-made cases (FIXTURES.md section 2)."""
import datetime as dt
import json

from pyspark.sql import functions as F

from activity_lake.functions.actors import classify_actor, is_bot
from activity_lake.functions.timefn import boundary_hours, weekday_sun0
from activity_lake.operators import bronze as B
from activity_lake.operators import dims, facts
from activity_lake.operators import silver as S
from conftest import pr_doc, raw_df


def _pr(spark, lines):
    return S.to_pr_events(B.to_bronze(raw_df(spark, lines)))


def test_merge_conventions(spark):
    rows = _pr(spark, [
        (pr_doc(1, action="closed", merged=True), "2025-08-13"),                 # 1
        (pr_doc(2, action="closed", merged=False, pr_id=8), "2025-08-13"),      # 2
        (pr_doc(3, action="merged", full=False, pr_id=9), "2025-11-01"),        # 3
        (pr_doc(4, action="closed", full=False, pr_id=10), "2025-11-01"),       # 4
    ]).orderBy("event_id").collect()
    assert [(r.payload_format, r.is_merge) for r in rows] == [
        ("full", True), ("full", False), ("reduced", True), ("reduced", False)]
    assert rows[3].pr_merged is None and rows[3].is_merge is False


def test_malformed_and_blank_lines(spark):
    raw = raw_df(spark, [("not json", "2025-08-13"), ("", "2025-08-13"),
                         (pr_doc(1), "2025-08-13")])
    br = B.to_bronze(raw)
    assert br.count() == 3
    assert br.where(F.col("id").isNull()).count() == 2
    assert S.to_events(br).count() == 1
    assert S.to_pr_events(br).count() == 1


def test_payload_from_the_envelope_parse(spark):
    """The stored payload gives the silver rows that parsing the text gives, on odd lines too."""
    day = "2025-08-13"
    odd = pr_doc(5, full=False)
    odd["payload"] = "not an object"
    texts = pr_doc(6)
    texts["payload"]["pull_request"].update({"id": "12", "number": 3.5, "merged": "true", "user": 4, "additions": {"a": 1}})
    bad_actor = pr_doc(8)
    bad_actor["actor"] = "alice"
    none = pr_doc(9)
    del none["payload"]
    raw = raw_df(spark, [(pr_doc(1), day), (pr_doc(1), day), (pr_doc(2, action="closed", merged=True), day),
                         (pr_doc(3, etype="PullRequestReviewEvent", review={"state": "approved", "submitted_at": "nope"}), day),
                         (pr_doc(4, etype="PushEvent"), day), (odd, day), (texts, day), (bad_actor, day), (none, day),
                         ("[1]", day), ("", day), (None, day), (json.dumps(pr_doc(7))[:-3], day)])
    for types in (None, ["PullRequestEvent"]):
        text = B.retain_payload(B.to_bronze(raw), types)
        both = B.retain_payload(B.to_bronze(raw, payload=True), types)
        assert sorted(map(str, text.collect())) == sorted(map(str, both.drop("pr").collect()))
        want = sorted(map(str, S.to_pr_events(text).collect()))
        assert len(want) == (7 if types is None else 6)
        assert sorted(map(str, S.to_pr_events(both).collect())) == want


def test_null_actor_and_repo(spark):
    doc = pr_doc(1)
    doc["actor"] = {}
    doc2 = pr_doc(2)
    doc2["repo"] = {}
    ev = S.to_events(B.to_bronze(raw_df(spark, [(doc, "2025-08-13"), (doc2, "2025-08-13")])))
    r = {x.event_id: x for x in ev.collect()}
    assert r[1].actor is None and r[1].is_bot is None and r[1].actor_class == "other_bot"
    assert r[2].repo is None and r[2].actor_class == "human"


def test_dedup_same_day_and_reuse_across_days(spark):
    d = pr_doc(5)
    other = pr_doc(5, etype="PullRequestReviewEvent", created="2025-08-14T01:00:00Z")
    ev = S.to_events(B.to_bronze(raw_df(spark, [(d, "2025-08-13"), (d, "2025-08-13"),
                                                (other, "2025-08-14")])))
    assert ev.count() == 2                                   # 7 and 8
    assert ev.select("event_type").distinct().count() == 2


def test_actor_classes(spark):
    df = spark.createDataFrame([(x,) for x in ["claude[bot]", "renovate[bot]", "vercel[bot]",
                                               "zzz[bot]", "claude"]], "login string")
    got = [r[0] for r in df.select(classify_actor(F.col("login"))).collect()]
    assert got == ["ai_agent", "dependency_bot", "ci_bot", "other_bot", "human"]
    assert [r[0] for r in df.select(is_bot(F.col("login"))).collect()] == [True, True, True, True, False]


def test_boundary_minutes(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:59", "2025-01-01 00:01:01")], "a string, b string")
    h = df.select(boundary_hours(F.to_timestamp("a"), F.to_timestamp("b"))).first()[0]
    assert abs(h - 1 / 60) < 1e-12


def _lifecycle(spark, lines, hi="2025-12-31"):
    return facts.pr_lifecycle(_pr(spark, lines), hi).collect()


def test_review_before_opening_and_merge_without_opening(spark):
    rev = {"state": "approved", "submitted_at": "2025-08-13T09:00:00Z"}
    r = _lifecycle(spark, [
        (pr_doc(1, etype="PullRequestReviewEvent", action="created", created="2025-08-13T09:00:00Z",
                review=rev), "2025-08-13"),
        (pr_doc(2, created="2025-08-13T10:00:00Z"), "2025-08-13"),
        (pr_doc(3, action="merged", full=False, pr_id=99, created="2025-08-14T10:00:00Z"), "2025-08-14"),
    ])
    by = {x.pr_id: x for x in r}
    assert by[7].hours_to_first_review is None and by[7].first_review_ts is not None       # 11
    assert by[99].opening_observed is False and by[99].merge_observed is True              # 12
    assert by[99].author is None


def test_maturity_boundary(spark):
    hi = "2025-12-31"   # cutoff 2025-12-01 00:00:00
    r = _lifecycle(spark, [
        (pr_doc(1, pr_id=1, created="2025-12-01T00:00:00Z"), "2025-12-01"),
        (pr_doc(2, pr_id=2, created="2025-12-01T00:00:01Z"), "2025-12-01"),
    ], hi)
    by = {x.pr_id: x.mature_cohort for x in r}
    assert by == {1: True, 2: False}                                                       # 13


def test_latest_language(spark):
    pr = _pr(spark, [(pr_doc(1, language="A"), "2025-08-01"), (pr_doc(2, language="B"), "2025-08-02"),
                     (pr_doc(3, language=None), "2025-08-03")])
    assert dims.repo_latest_language(pr).first()["language"] == "B"                        # 14


def test_two_cohorts_for_two_repos(spark):
    ev = S.to_events(B.to_bronze(raw_df(spark, [
        (pr_doc(1, repo="o/a", created="2025-08-01T00:00:00Z"), "2025-08-01"),
        (pr_doc(2, repo="o/b", created="2025-09-01T00:00:00Z"), "2025-09-01"),
        (pr_doc(3, repo="o/a", created="2025-09-02T00:00:00Z"), "2025-09-02")])))
    c = facts.contributor_month(ev).collect()
    cohorts = {(x.repo, x.month): (x.cohort_month, x.months_of_life, x.is_first_month) for x in c}
    assert cohorts[("o/a", dt.date(2025, 9, 1))] == (dt.date(2025, 8, 1), 1, False)       # 15
    assert cohorts[("o/b", dt.date(2025, 9, 1))] == (dt.date(2025, 9, 1), 0, True)


def test_weekday_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2025, 8, 17),), (dt.date(2025, 8, 16),), (dt.date(2025, 8, 18),)], "d date")
    assert [r[0] for r in df.select(weekday_sun0(F.col("d"))).collect()] == [0, 6, 1]      # 16


def test_payload_retention_keeps_rows(spark):
    doc = pr_doc(1)
    doc["type"] = "WatchEvent"
    br = B.retain_payload(B.to_bronze(raw_df(spark, [(doc, "2025-08-13"), (pr_doc(2), "2025-08-13")])))
    rows = {r.id: r.event_json for r in br.collect()}
    assert rows["1"] is None and rows["2"] is not None                                     # 17
    assert B.parse_type_list(" A, B,,C ") == ["A", "B", "C"]
