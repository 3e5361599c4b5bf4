"""Late data: whatever the order of arrival, the stream keeps every key once; files
whose names give no day stop the job."""
import json

import pytest

from activity_lake.plans import jobs
from activity_lake.sources import sinks as SK
from activity_lake.streaming import incremental as INC
from conftest import pr_doc


def _write(path, day, hour, ids):
    path.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(pr_doc(i, created=f"{day}T{hour:02d}:00:00Z")) for i in ids]
    (path / f"{day}-{hour}.json").write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_late_rows_survive_the_in_stream_dedup(spark, tmp_path, per_trigger):
    raw, out, ckpt = tmp_path / "raw", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    _write(raw, "2025-08-13", 1, [1])
    _write(raw, "2025-08-20", 1, [2, 2])
    INC.stream_dedup(spark, str(raw), out, ckpt, per_trigger)
    _write(raw, "2025-08-13", 2, [3, 1])
    _write(raw, "2025-08-21", 1, [4])
    INC.stream_dedup(spark, str(raw), out, ckpt, per_trigger)
    got = sorted((r["event_id"], str(r["event_date"])) for r in SK.read_layer(spark, out).collect())
    assert got == [(1, "2025-08-13"), (2, "2025-08-20"), (3, "2025-08-13"), (4, "2025-08-21")]


def test_unrecognised_file_names_fail_the_job(spark, tmp_path):
    raw = tmp_path / "raw"
    _write(raw, "2025-08-13", 1, [1])
    assert jobs.bronze_job(spark, str(raw), f"{tmp_path}/bronze")["written"] == 1
    (raw / "notes.json").write_text("{}\n")
    with pytest.raises(RuntimeError):
        jobs.bronze_job(spark, str(raw), f"{tmp_path}/bronze")


def test_ten_batches_with_late_rows_equal_the_batch_dedup_and_read_their_days_only(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", f"{tmp_path}/out"
    everything, scans = [], []
    unseen = INC.unseen

    def watched(events, keys_path, days, batch_id):
        df = unseen(events, keys_path, days, batch_id)
        files = [f for f in df.inputFiles() if "out_keys" in f]
        scans.append((sorted(map(str, days)), sorted({f.split("event_date=")[1][:10] for f in files})))
        return df
    monkeypatch.setattr(INC, "unseen", watched)
    for wave in range(10):      # a new day, and late repeated and new rows of two older ones
        for day in {wave, max(wave - 2, 0), max(wave - 5, 0)}:
            ids = [day * 100 + k for k in range(wave % 4 + 3)] + [7, 7]
            _write(raw, f"2025-08-{10 + day}", wave, ids)
            everything += [(i, f"2025-08-{10 + day}") for i in ids]
        INC.stream_dedup(spark, str(raw), out, f"{tmp_path}/ckpt")
    got = sorted((r["event_id"], str(r["event_date"])) for r in SK.read_layer(spark, out).collect())
    assert got == sorted(set(everything))
    keys = spark.read.parquet(f"{out}_keys")
    assert keys.count() == len(got) and set(keys.columns) == {"event_id", "event_date", "batch"}
    assert len(scans) == 10 and all(set(read) <= set(days) and len(days) <= 3 for days, read in scans)
    assert sum(len(read) for _, read in scans) >= 10


def test_a_killed_batch_is_repeated_whole(spark, tmp_path, monkeypatch):
    raw, args = tmp_path / "raw", (str(tmp_path / "raw"), f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/ckpt")
    _write(raw, "2025-08-13", 1, [1, 2, 2])
    INC.run_incremental(spark, *args)
    _write(raw, "2025-08-13", 2, [2, 3])
    _write(raw, "2025-08-14", 0, [4])
    rebuild = INC._rebuild_silver

    def killed(*a):
        raise OSError("killed between the bronze write and the silver rebuild")
    monkeypatch.setattr(INC, "_rebuild_silver", killed)
    with pytest.raises(Exception, match="killed"):
        INC.run_incremental(spark, *args)
    assert spark.read.parquet(args[1]).count() == 6        # bronze has the batch, silver not
    assert SK.read_layer(spark, f"{args[2]}/events").count() == 2
    monkeypatch.setattr(INC, "_rebuild_silver", rebuild)
    INC.run_incremental(spark, *args)
    INC.run_incremental(spark, *args)
    assert spark.read.parquet(args[1]).count() == 6
    for table in ("events", "pr_events"):
        rows = SK.read_layer(spark, f"{args[2]}/{table}").select("event_id", "event_date").collect()
        assert sorted((r[0], str(r[1])) for r in rows) == [(1, "2025-08-13"), (2, "2025-08-13"), (3, "2025-08-13"), (4, "2025-08-14")]


def test_a_killed_dedup_batch_is_repeated_whole(spark, tmp_path, monkeypatch):
    raw, out, ckpt = tmp_path / "raw", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    _write(raw, "2025-08-13", 1, [1])
    INC.stream_dedup(spark, str(raw), out, ckpt)
    _write(raw, "2025-08-13", 2, [1, 2])
    write = INC._write_batch

    def killed(df, path, batch_id):
        if path.endswith("_keys"):
            raise OSError("killed before the index is written")
        return write(df, path, batch_id)
    monkeypatch.setattr(INC, "_write_batch", killed)
    with pytest.raises(Exception, match="killed"):
        INC.stream_dedup(spark, str(raw), out, ckpt)
    monkeypatch.setattr(INC, "_write_batch", write)
    INC.stream_dedup(spark, str(raw), out, ckpt)
    assert sorted(r[0] for r in SK.read_layer(spark, out).select("event_id").collect()) == [1, 2]
    assert sorted(r[0] for r in spark.read.parquet(f"{out}_keys").select("event_id").collect()) == [1, 2]
