import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from activity_lake.session import build_session
    # spark.checkpoint.dir comes from the session; shared_dir() sets a local
    # one only when it is unset.
    s = build_session("tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def pr_doc(eid, etype="PullRequestEvent", created="2025-08-13T10:00:00Z", actor="alice", repo="o/r",
           action="opened", pr_id=7, full=True, merged=None, language="Go", review=None,
           pr_created="2025-08-13T10:00:00Z"):
    pr = {"id": pr_id, "number": pr_id}
    if full:
        pr.update({"created_at": pr_created, "user": {"login": actor, "type": "User"},
                   "additions": 1, "deletions": 2, "base": {"repo": {"language": language}}})
        if merged is not None:
            pr["merged"] = merged
    payload = {"action": action, "number": pr_id, "pull_request": pr}
    if review is not None:
        payload["review"] = review
    return {"id": str(eid), "type": etype, "created_at": created,
            "actor": {"login": actor}, "repo": {"name": repo}, "payload": payload}


def raw_df(spark, lines):
    """lines: list of (text_or_dict, file_date) -> raw DataFrame."""
    rows = []
    for text, day in lines:
        if isinstance(text, dict):
            text = json.dumps(text)
        rows.append((text, day, 0))
    return spark.createDataFrame(rows, "value string, file_date string, file_hour int")
