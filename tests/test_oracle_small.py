"""A representative slice of queries() against oracle_sql() on sf0.001
(the full set runs with tools/check_oracle.py)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tools.check_oracle import TABLES, rows_of

NAMES = ["events_typed", "pr_events_typed", "dedup_by_day", "dim_repo", "pr_lifecycle",
         "contributor_month", "monthly_activity", "monthly_latency", "top_repos",
         "q_null_profile", "q_reconcile", "pending_days", "p_key_coverage", "stream_equals_batch"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"month", "actor_class", "events", "repos", "actors"}


def test_every_query_has_operators_and_most_have_oracles():
    from activity_lake.plans.registry import OPERATORS
    qs, sq = E.queries(), E.oracle_sql()
    assert all(OPERATORS[n] for n in qs if not n.startswith("op") and n != "pipeline")
    assert set(sq) <= set(qs)
    assert {k for k in set(qs) - set(sq) if not k.startswith("op") and k != "pipeline"} == set()


def test_registry_imports_without_a_session():
    """The driver may call oracle_sql() before any SparkSession exists."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "assert len(E.oracle_sql()) >= 75 and len(E.queries()) >= 78" % os.getcwd())
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
