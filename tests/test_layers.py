"""Measures against the file system, layer schemas, sketches, overlap of days, plan shapes."""
import gzip
import hashlib
import json
import os
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from activity_lake.operators import facts, profiling as PF, quality as Q, reports as R
from activity_lake.plans import adapters as A
from activity_lake.plans import jobs
from activity_lake.plans.pipeline import Lake
from activity_lake.schemas import EVENTS, PR_EVENTS
from activity_lake.sources import raw as RAW
from activity_lake.sources import sinks as SK
from conftest import SF001, pr_doc
from test_plans import _formatted


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """Hourly files of two days, one of them empty and one of several megabytes."""
    root = tmp_path_factory.mktemp("archive")
    rng = random.Random(1)
    for day, hour, n in (("2025-08-13", 0, 3), ("2025-08-13", 5, 20_000), ("2025-08-14", 23, 7)):
        with gzip.open(root / f"{day}-{hour}.json.gz", "wt") as f:
            for i in range(n):
                f.write(json.dumps(pr_doc(hour * 10**6 + i, created=f"{day}T{hour:02d}:00:00Z") | {"pad": "é%x" % rng.getrandbits(800)}, ensure_ascii=False) + "\n")
    (root / "2025-08-14-7.json.gz").write_bytes(b"")
    return root


def test_checksums_and_sizes_are_the_files_own(spark, archive):
    files = {f.name: f.read_bytes() for f in archive.iterdir()}
    assert max(map(len, files.values())) > 2 << 20
    got = {os.path.basename(r["path"]): (r["bytes"], r["sha256"]) for r in RAW.file_checksums(spark, str(archive)).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in files.items()}
    some = {os.path.basename(r["path"]): r["sha256"] for r in RAW.file_checksums(spark, str(archive), max_bytes=100_000).collect()}
    assert {n for n, h in some.items() if h is None} == {n for n, b in files.items() if len(b) > 100_000} and len(some) == len(files)
    inv = {os.path.basename(r["path"]): (r["bytes"], r["state"], str(r["file_date"]), r["file_hour"]) for r in RAW.file_inventory(spark, str(archive)).collect()}
    assert inv["2025-08-14-7.json.gz"] == (0, "empty", "2025-08-14", 7)
    assert {n: v[0] for n, v in inv.items()} == {n: len(b) for n, b in files.items()}


def test_file_volume_matches_the_files(spark, archive):
    got = {os.path.basename(r["path"]): r for r in RAW.file_volume(spark, str(archive)).collect()}
    assert len(got) == 4
    for f in archive.iterdir():
        data = f.read_bytes()
        lines = gzip.decompress(data).splitlines() if data else []
        r = got[f.name]
        assert (r["lines"], r["text_bytes"], r["compressed_bytes"]) == (len(lines), sum(map(len, lines)), len(data))
        assert r["ratio"] == (round(r["text_bytes"] / len(data), 4) if data else None)


def test_storage_report_and_run_log_hold_the_real_sizes(spark, archive, tmp_path):
    bronze = f"{tmp_path}/bronze"
    raw = spark.read.text(str(archive)).count()
    assert jobs.bronze_job(spark, str(archive), bronze)["written"] == raw
    sizes = defaultdict(int)
    for f in archive.iterdir():
        sizes[f.name[:10]] += f.stat().st_size
    out = {d: sum(os.path.getsize(f"{bronze}/event_date={d}/{n}") for n in os.listdir(f"{bronze}/event_date={d}") if n.endswith(".parquet")) for d in sizes}
    rep = {str(r["event_date"]): r for r in RAW.storage_report(spark, str(archive), bronze).collect()}
    assert {d: (r["bytes_in"], r["bytes_out"]) for d, r in rep.items()} == {d: (sizes[d], out[d]) for d in sizes}
    assert all(r["ratio"] == round(r["bytes_out"] / r["bytes_in"], 4) for r in rep.values())
    own = RAW.storage_report(spark, str(archive), bronze)
    log = SK.log_records(SK.per_day_counts(spark, bronze), "bronze", 1.5, bytes_in=own, bytes_out=own)
    SK.append_run_log(spark, log, f"{tmp_path}/log")
    assert {str(r["event_date"]): (r["bytes_in"], r["bytes_out"]) for r in SK.read_run_log(spark, f"{tmp_path}/log").collect()} == {
        d: (sizes[d], out[d]) for d in sizes}


def test_volume_text_bytes_are_the_lines_own(spark):
    raw = A.profile_feed(spark, SF001)
    assert PF.volume(raw).first()["text_bytes"] == sum(len((r[0] or "").encode()) for r in raw.select("value").collect())


def test_layers_read_with_their_schema_take_older_files(spark, tmp_path):
    lake = Lake(spark, SF001)
    assert {f.name: f.dataType for f in lake.pr_events().schema} == {f.name: f.dataType for f in PR_EVENTS}
    assert {f.name: f.dataType for f in lake.events().schema} == {f.name: f.dataType for f in EVENTS}
    old = lake.stream_events().where("event_date = '2024-01-03'").drop("actor_class")       # written before the column came
    new = lake.stream_events().where("event_date = '2024-01-04'")
    for df in (old, new):
        df.write.mode("append").partitionBy("event_date").parquet(f"{tmp_path}/events")
    back = SK.read_layer(spark, f"{tmp_path}/events", EVENTS)
    assert back.columns and set(back.columns) == {f.name for f in EVENTS}
    assert back.where("actor_class is null").count() == old.count() > 0 and back.count() == old.count() + new.count()


def test_sketches_estimate_the_exact_exports(spark, tmp_path):
    lake = Lake(spark, SF001)
    fact, contrib = lake.gold("fact_pr_event"), lake.gold("contributor_month")
    R.daily_sketches(fact).write.partitionBy("date").parquet(f"{tmp_path}/daily")
    R.retention_sketches(contrib).write.parquet(f"{tmp_path}/retention")
    bound = 4 * 1.04 / 2 ** (R.SKETCH_LG / 2)
    near = lambda a, b: abs(a - b) <= max(1, bound * b)
    got = {(r["month"], r["actor_class"]): r for r in R.monthly_activity_estimate(spark.read.parquet(f"{tmp_path}/daily")).collect()}
    want = R.monthly_activity(fact).collect()
    assert len(got) == len(want) > 50
    for r in want:
        e = got[r["month"], r["actor_class"]]
        assert e["events"] == r["events"] and near(e["repos"], r["repos"]) and near(e["actors"], r["actors"])
    got = {(r["cohort_month"], r["months_of_life"]): r for r in R.retention_estimate(spark.read.parquet(f"{tmp_path}/retention")).collect()}
    want = R.retention_curve(contrib).collect()
    assert len(got) == len(want)
    assert all(near(got[r[0], r[1]]["actors"], r["actors"]) and near(got[r[0], r[1]]["repos"], r["repos"]) for r in want)
    many = spark.range(300_000).select(F.lit(date(2025, 1, 1)).alias("date"), F.lit("human").alias("actor_class"),
                                       (F.col("id") % 90_000).cast("string").alias("repo"), F.col("id").cast("string").alias("actor"))
    r = R.monthly_activity_estimate(R.daily_sketches(many)).first()
    assert near(r["repos"], 90_000) and near(r["actors"], 300_000)


def test_overlap_of_given_days(spark):
    rng = random.Random(7)
    lo = date(2025, 1, 1)
    rows = [(rng.randint(0, 40) if rng.random() < 0.95 else None, lo + timedelta(days=rng.choice([0, 1, 2, 63, 64, 65, 127, 128, 140]))) for _ in range(150)]
    df = spark.createDataFrame(rows, "event_id long, event_date date").repartition(3)
    by = defaultdict(set)
    for i, d in rows:
        by[d].add(i)
    days = [lo + timedelta(days=i) for i in (*range(0, 70), 127, 128, 139, 140)]
    for pairs in (list(combinations(days, 2)), [(days[0], days[2]), (days[2], days[0]), (days[1], days[1])], []):
        got = Q.day_overlap(df, pairs).collect()
        want = {p: len((by[p[0]] & by[p[1]]) - {None}) for p in pairs if p[0] != p[1]}
        assert {(r[0], r[1]): r[2] for r in got if r[0] != r[1]} == want and len(got) == len(set(pairs))
    assert Q.day_pairs("2025-01-01", "2025-01-03") == [(lo, lo + timedelta(1)), (lo, lo + timedelta(2)), (lo + timedelta(1), lo + timedelta(2))]


def test_contributor_month_needs_no_expand(spark):
    plan = _formatted(Lake(spark, SF001).contributor_month())
    assert "Expand" not in plan


def test_profiles_parse_a_line_once_and_need_no_global_window(spark):
    raw = Lake(spark, SF001).profile_raw()
    frames = {"types": PF.type_frequency(raw), "keys": PF.key_coverage(raw, ("PullRequestEvent", "payload.pull_request"), ("PushEvent", "payload")),
              "drift": PF.drift(raw, F.substring("file_date", 1, 4))}
    for name, df in frames.items():
        plan = _formatted(df)
        assert "Window" not in plan and "json_object_keys" not in plan and "get_json_object" not in plan and "from_json" not in plan
        projects = re.findall(r"\n\(\d+\) (?:Project|HashAggregate|Generate)[^\n]*\n(?:.*\n)*?\n", plan)
        parses = [p.count("parse_json") + p.count("parseJson") for p in projects]
        assert max(parses, default=1) <= 1, name


def test_key_coverage_of_objects_arrays_and_maps(spark):
    lines = [{"type": "A", "payload": {"x": {"b": 1, "a": None}}}, {"type": "A", "payload": {"x": [1]}}, {"type": "A", "payload": {}}, {"type": "A"},
             {"type": "A", "payload": {"x": {f"k{i}": 0 for i in range(50)}}}, {"type": "B", "payload": {"x": {"a": 1}}}, {"type": "C", "payload": 5}]
    raw = spark.createDataFrame([(json.dumps(x), "d") for x in lines] + [("{bad", "d"), (None, "d")], "value string, file_date string")
    got = {(r["object"], r["key"]): (r["events"], r["type_events"]) for r in PF.key_coverage(raw, ("A", "payload.x"), ("A", "payload"), ("B", "payload.x")).collect()
           if not r["key"].startswith("k")}
    assert Counter(got) and {k: v for k, v in got.items() if k[0] == "payload"} == {("payload", "x"): (3, 5)}
    both = [tuple(r) for r in PF.key_coverage(raw, ("A", "payload.x"), ("B", "payload.x")).where("key = 'a'").select("events", "type_events").collect()]
    assert sorted(both) == [(1, 1), (1, 5)]
    assert PF.key_coverage(raw, ("Z", "payload")).count() == 0 and PF.key_coverage(raw, ("C", "payload")).count() == 0


def test_paths_of_lines_nested_however_deep(spark):
    deep = "[" * 3000 + "]" * 3000
    objects = '{"k":' * 2000 + "1" + "}" * 2000
    lines = ['{"type":"A","payload":{"a":%s}}' % deep, '{"type":"A","payload":%s}' % objects, "[" * 200_000, '{"type":"A","payload":{"a":[1,}}',
             '{"type":"A","payload":{"b":2}}']
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r["path"], r["value_type"]): r["occurrences"] for r in PF.observed_paths(raw).collect()}
    want = Counter({("payload.a" + "[]" * i, "list"): 1 for i in range(3000)})
    want.update({("payload" + ".k" * (i + 1), "dict" if i < 1999 else "int"): 1 for i in range(2000)})
    want["payload.b", "int"] = 1
    assert got == want


def test_parse_of_deep_texts_agrees_with_the_usual_one(monkeypatch):
    texts = ['{"a": [1, 2.5, -3e4, true, null, "x\\n\\u00e9"], "b": {}, "c": [[], {"d": [{}]}]}', "[]", " {} ", "3", '"s"', "[1,]", "[,1]", "{1:2}", '{"a"}', '{"a":}', "[1 2]",
             "", "]", "[}", '{"a":1,}', "nul", "[1]]", '{"a":1 "b":2}', '["\\q"]', "[[1],[2,[3]]]", '{"a":{"a":{"a":1},"b":2}}', "[1", '{"a":1']
    usual = PF.json.loads
    for t in texts:
        try:
            want = usual(t)
        except ValueError:
            want = ValueError
        calls = []

        def loads(x):
            calls.append(x)
            if len(calls) == 1:
                raise RecursionError
            return usual(x)
        with monkeypatch.context() as m:
            m.setattr(PF.json, "loads", loads)
            try:
                got = PF._parse(t)
            except ValueError:
                got = ValueError
        assert got == want, t
