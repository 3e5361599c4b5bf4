"""Disk: silver's dedup of a stored layer shuffles keys alone, and a written table leaves no shuffle files."""
import re

from activity_lake.operators import bronze as B
from activity_lake.operators import silver as S
from activity_lake.plans import pipeline as P
from activity_lake.sources import raw as RAW
from activity_lake.sources import sinks as SK
from activity_lake.streaming import incremental as INC
from conftest import SF001, pr_doc, raw_df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffled(df):
    """Columns of the rows below each shuffle."""
    txt = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) (?:Exchange|ShuffleQueryStage)[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", txt)


def _layer(spark, path, lines, payload):
    SK.write_partitioned(B.retain_payload(B.to_bronze(raw_df(spark, lines), payload=payload)), path)
    return SK.read_layer(spark, path)


def test_a_stored_layer_is_deduplicated_by_key_and_position(spark, tmp_path):
    """Ids used on other days or without a day, copies with other contents, a hot key, lines without an id."""
    lines = [(pr_doc(i % 40, action=f"a{i}"), [f"2025-08-{13 + i % 2}", None][i % 5 == 0]) for i in range(200)]
    lines += [(pr_doc(7, action=f"hot{i}"), "2025-08-20") for i in range(50)] + [(pr_doc(7, etype="PushEvent"), "2025-08-21"), ("{broken", "2025-08-20")]
    key = lambda df: sorted(map(str, df.select("event_id", "event_date").collect()))
    for payload in (False, True):
        bronze = _layer(spark, str(tmp_path / f"b{payload}"), lines, payload)
        for silver in (S.to_events, S.to_pr_events):
            got, want, every = silver(bronze, store=SK.stored), silver(bronze), silver(bronze, dedup=False)
            assert got.dtypes == want.dtypes == every.dtypes
            assert key(got) == key(want)
            rows = list(map(str, got.collect()))
            assert len(rows) == len(set(rows)) and set(rows) <= set(map(str, every.collect()))
        assert S.to_events(bronze, dedup=False, store=SK.stored).dtypes == S.to_events(bronze).dtypes


def test_one_of_equal_copies_stays_where_every_row_has_some(spark, tmp_path):
    lines = [(pr_doc(i % 30), "2025-08-13") for i in range(90)]
    bronze = _layer(spark, str(tmp_path / "b"), lines, True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # as with too many repeated keys
    try:
        got = S.to_pr_events(bronze, store=SK.stored)
        assert "BroadcastHashJoin" not in _plan(got)
        assert sorted(map(str, got.collect())) == sorted(map(str, S.to_pr_events(bronze).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_of_the_lake_shuffles_no_wide_row(spark, monkeypatch):
    written = []
    write = SK.write_table
    monkeypatch.setattr(P, "_LAYERS", {})
    monkeypatch.setattr(SK, "write_table", lambda df, *a, **k: (written.append((a[0], _shuffled(df))), write(df, *a, **k)))
    lake = P.Lake(spark, SF001)
    assert lake.pr_events().count() and lake.events().count()
    silver = [s for p, s in written if "pr_silver" in p]
    keys = [s for p, s in written if "/stored-" in p]
    assert silver == [[], []]
    assert len(keys) == 2 and all(len(s) == 1 and "actor" not in s[0] and "event_id" in s[0] for s in keys)


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    df = spark.range(10000).selectExpr("id % 1000 AS k", "cast('2024-01-01' AS date) AS event_date").groupBy("k", "event_date").count()
    before = _shuffle_files(spark)
    SK.write_table(df, str(tmp_path / "a"))
    SK.write_partitioned(df, str(tmp_path / "b"), rebalance=True)
    SK.export(df, str(tmp_path / "c"))
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert df.count() == df.count() == len(df.collect()) == len(df.collect()) == 1000       # its shuffles can be made again


def test_a_stream_leaves_no_shuffle_files_and_deduplicates_by_keys(spark, tmp_path, monkeypatch):
    base, keys, store = str(tmp_path), [], SK.stored
    monkeypatch.setattr(INC, "stored", lambda df: (keys.append(_shuffled(df)), store(df))[1])
    lines = [(pr_doc(i % 40, action="opened"), "2025-08-13") for i in range(100)]
    before = _shuffle_files(spark)
    for wave in (lines[:30], lines[30:]):
        RAW.write_raw(raw_df(spark, wave), f"{base}/raw", mode="append")
        INC.run_incremental(spark, f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/_ckpt")
    assert not _shuffle_files(spark) - before
    assert len(keys) == 4 and all(len(s) == 1 and "actor" not in s[0] for s in keys)
    for table in ("events", "pr_events"):
        rows = SK.read_layer(spark, f"{base}/silver/{table}").collect()
        assert sorted(r["event_id"] for r in rows) == list(range(40))
