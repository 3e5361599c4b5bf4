"""Static conventions of the library: no UDFs, no RDD code, no local
checkpoints, broadcasts only through the bounded helper."""
import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "activity_lake")


def _sources():
    for d, dirs, files in os.walk(ROOT):
        dirs[:] = [x for x in dirs if x != "llm"]  # a subpackage with rules and tests of its own
        for f in files:
            if f.endswith(".py"):
                p = os.path.join(d, f)
                yield os.path.relpath(p, ROOT), open(p).read()


def test_no_udfs_rdds_or_local_checkpoints():
    bad = re.compile(r"\budf\(|pandas_udf|\.rdd\.map|mapPartitions|localCheckpoint")
    hits = [p for p, src in _sources() if bad.search(src)]
    assert hits == []


def test_broadcast_only_through_bounded_helper():
    hits = [p for p, src in _sources() if "F.broadcast(" in src and not p.endswith("joins.py")]
    assert hits == []
