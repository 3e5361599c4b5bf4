"""The adapters reproduce the counts measured in FIXTURES.md section 3 (sf0.01),
through the Spark JSON path."""
import pytest
from pyspark.sql import functions as F

from activity_lake.operators import reports as R
from activity_lake.operators import silver as S
from activity_lake.plans.pipeline import Lake

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF01)


def test_adapter_e_counts(lake):
    raw = S.to_events(lake.event_bronze_stored(), dedup=False)
    assert raw.count() == 10217
    assert raw.select("event_id").distinct().count() == 10000
    assert lake.stream_events().count() == 10113


def test_adapter_p_counts(lake):
    raw = S.to_events(lake.pr_bronze_stored(), dedup=False)
    assert raw.count() == 83657
    assert lake.events().count() == 83649
    assert lake.events().select("event_id").distinct().count() == 69489


def test_window_counts(lake):
    ev = lake.stg_events()
    assert ev.count() == 81740
    assert ev.select("repo").distinct().count() == 350
    assert ev.select("actor").distinct().count() == 997
    classes = {r[0]: r[1] for r in ev.groupBy("actor_class").count().collect()}
    assert classes == {"human": 64711, "ai_agent": 12871, "ci_bot": 1369,
                       "other_bot": 1408, "dependency_bot": 1381}
    lc = lake.pr_lifecycle()
    assert lc.count() == 14987
    assert lc.where("mature_cohort").count() == 13538
    assert lc.where("opening_observed AND NOT mature_cohort").count() == 98
    contrib = lake.contributor_month()
    assert contrib.count() == 77951
    assert R.repo_balance(contrib).count() == 2489


def test_whole_range_lifecycle(spark):
    lc = Lake(spark, SF01, window=("1990-01-01", "2010-12-31")).pr_lifecycle()
    assert lc.count() == 14990
    o, m = F.col("opening_observed"), F.col("merge_observed")
    got = {k: lc.where(c).count() for k, c in
           {"TT": o & m, "TF": o & ~m, "FT": ~o & m, "FF": ~o & ~m}.items()}
    assert got == {"TT": 4471, "TF": 9165, "FT": 462, "FF": 892}
    assert lc.where(F.col("hours_to_first_review").isNotNull()).count() == 3178
    elapsed = F.floor((F.unix_timestamp("merged_ts") - F.unix_timestamp("opened_ts")) / 60)
    h = F.col("hours_to_merge")
    assert lc.where(h.isNotNull()).count() == 4471
    assert lc.where(h.isNotNull() & (F.round(h * 60, 6) != elapsed)).count() == 1839
