"""G1: every export's files hold its rows in the published order."""
import pytest

from activity_lake.operators.reports import EXPORT_ORDER, ordered_export
from activity_lake.plans.pipeline import Lake
from activity_lake.plans.q_io import _named_exports
from activity_lake.sources import sinks as SK
from conftest import SF001


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    out = f"{tmp_path_factory.mktemp('exports')}"
    named = _named_exports(Lake(spark, SF001))
    SK.export_all(spark, out, named)
    return {n: spark.read.parquet(f"{out}/{n}") for n in named}


@pytest.mark.parametrize("name", sorted(EXPORT_ORDER))
def test_files_are_in_order(exports, name):
    files = sorted(f for f in exports[name].inputFiles())
    rows = [r for f in files for r in exports[name].sparkSession.read.parquet(f).collect()]
    for (col, desc) in reversed(EXPORT_ORDER[name]):
        assert all(r[col] is not None for r in rows)
    want = list(rows)
    for col, desc in reversed(EXPORT_ORDER[name]):
        want.sort(key=lambda r: r[col], reverse=desc)
    assert rows == want and len(rows) == ordered_export(name, exports[name]).count()


def test_one_export_builds_only_the_gold_table_it_reads(spark):
    """the calendar's export needs neither pull requests nor contributors."""
    built = []

    class Seen(Lake):
        def gold(self, name):
            built.append(name)
            return getattr(self, name)()

    day = spark.sql("SELECT DATE'2025-01-02' AS event_date")
    lake = Seen(spark, events=day, window=("2025-01-01", "2025-01-03"), format_change="2025-01-02", gap=None)
    got = {str(r["date"]): r["has_data"] for r in _named_exports(lake, ["calendar_export"])["calendar_export"].collect()}
    assert built == ["dim_date"] and got == {"2025-01-01": False, "2025-01-02": True, "2025-01-03": False}
