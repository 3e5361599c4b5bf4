"""Plan tests: the physical plans have the intended shape."""
import re

from pyspark.sql import functions as F

from activity_lake.operators import bronze as B
from activity_lake.operators import facts
from activity_lake.operators import silver as S
from activity_lake.plans.pipeline import Lake
from activity_lake.sources import sinks as SK
from conftest import SF001, pr_doc, raw_df


def _formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _exchange_inputs(df):
    txt = _formatted(df)
    out = []
    for m in re.finditer(r"\(\d+\) (?:Exchange|ShuffleQueryStage)[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", txt):
        out.append(m.group(1))
    return out


def _bronze_layer(spark, tmp_path):
    lines = [(pr_doc(i, created=f"2025-08-{13 + i % 3}T01:00:00Z"), f"2025-08-{13 + i % 3}") for i in range(30)]
    path = str(tmp_path / "bronze")
    SK.write_partitioned(B.retain_payload(B.to_bronze(raw_df(spark, lines))), path)
    return SK.read_layer(spark, path)


def test_no_json_crosses_the_dedup_exchange(spark, tmp_path):
    bronze = _bronze_layer(spark, tmp_path)
    for df in (S.to_events(bronze), S.to_pr_events(bronze)):
        ins = _exchange_inputs(df)
        assert ins, "expected a shuffle for the dedup"
        assert all("event_json" not in i for i in ins)


def test_silver_neither_parses_nor_reads_the_text_again(spark, tmp_path):
    lines = [(pr_doc(i, review={"state": "approved", "submitted_at": "2025-08-13T11:00:00Z"}), "2025-08-13") for i in range(5)]
    path = str(tmp_path / "bronze")
    SK.write_partitioned(B.retain_payload(B.to_bronze(raw_df(spark, lines), payload=True)), path)
    out = S.to_pr_events(SK.read_layer(spark, path))
    plan = _formatted(out)
    assert "from_json" not in plan and "event_json" not in plan
    assert {r.review_state for r in out.collect()} == {"approved"}


def test_lifecycle_sorts_on_the_number_first(spark):
    lines = [(pr_doc(i, pr_id=i), "2025-08-13") for i in range(5)]
    plan = _formatted(facts.pr_lifecycle(S.to_pr_events(B.to_bronze(raw_df(spark, lines))), "2025-12-31"))
    sorts = re.findall(r"Sort\nInput[^\n]*\nArguments: \[(\w+)#", plan)
    assert sorts.count("pr_id") >= 2 and "repo" not in sorts


def test_contributor_month_sorts_once(spark):
    plan = _formatted(facts.contributor_month(S.to_events(B.to_bronze(raw_df(spark, [(pr_doc(1), "2025-08-13")])))))
    after = plan[:plan.index("REPARTITION_BY_COL")]
    tree = after[:after.index("\n\n")].split("Exchange")[0]
    assert tree.count("Window") == 1 and len(re.findall(r"\bSort \(", tree)) == 1


def test_dedup_shuffles_on_the_composite_key(spark, tmp_path):
    bronze = _bronze_layer(spark, tmp_path)
    plan = _formatted(S.to_events(bronze))
    assert re.search(r"hashpartitioning\(event_id#\d+L, event_date#\d+", plan)


def test_window_clip_prunes_partitions(spark, tmp_path):
    bronze = S.stage(_bronze_layer(spark, tmp_path), "2025-08-14", "2025-08-14")
    plan = _formatted(bronze)
    assert re.search(r"PartitionFilters: \[.*event_date", plan)
    assert bronze.count() == 10


def test_classification_needs_no_join(spark, tmp_path):
    plan = _formatted(S.to_events(_bronze_layer(spark, tmp_path)))
    assert "Join" not in plan


def test_calendar_side_is_broadcast(spark):
    lake = Lake(spark, SF001)
    plan = _formatted(lake.dim_date())
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_projection_pushdown_on_table_scan(spark):
    lake = Lake(spark, SF001, materialize=False)
    plan = _formatted(lake.pr_raw())
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and "o_totalprice" not in m.group(1) and "o_orderpriority" not in m.group(1)


def test_lifecycle_single_aggregate_no_expand(spark):
    lake = Lake(spark, SF001)
    plan = _formatted(lake.pr_lifecycle())
    assert "Expand" not in plan            # review count needs no DISTINCT


def test_dedup_and_lifecycle_pre_aggregate_before_shuffle(spark, tmp_path):
    """A key holding a third of all rows must be combined map-side: every
    aggregate below an Exchange is a partial one."""
    lines = [(pr_doc(1, created="2025-08-13T01:00:00Z"), "2025-08-13")] * 60
    lines += [(pr_doc(i, created="2025-08-13T02:00:00Z", pr_id=i), "2025-08-13") for i in range(2, 122)]
    path = str(tmp_path / "hot")
    SK.write_partitioned(B.retain_payload(B.to_bronze(raw_df(spark, lines))), path)
    bronze = SK.read_layer(spark, path)
    ev = S.to_events(bronze)
    assert ev.count() == 121
    from activity_lake.operators import facts
    for df in (ev, facts.pr_lifecycle(S.to_pr_events(bronze), "2025-12-31")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan


def test_registered_date_queries_prune_partitions(spark):
    from activity_lake.plans.registry import QUERIES, load_all
    load_all()
    for name in ("partition_range", "partition_in_list"):
        assert re.search(r"PartitionFilters: \[[^\]]*event_date", _formatted(QUERIES[name](spark, SF001))), name


def test_coverage_card_and_uniqueness_plans(spark):
    from activity_lake.plans.registry import QUERIES, load_all
    load_all()
    assert "Scan parquet" in _formatted(QUERIES["coverage_card"](spark, SF001))
    for name in ("q_unique_per_day", "dedup_naive_loss"):
        assert "Expand" not in _formatted(QUERIES[name](spark, SF001)), name


def test_profiles_parse_each_line_once(spark):
    from activity_lake.operators import profiling as PF
    raw = Lake(spark, SF001).profile_raw()
    for op in (PF.candidate_paths, PF.bot_signals, PF.field_matrix, PF.identifier_coverage, PF.volume, PF.type_frequency):
        df = op(raw)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"try_parse_json|parse_json\(", plan)) <= 1, (op.__name__, plan)
        assert "get_json_object" not in plan, op.__name__


def test_dedup_keeps_the_survivor_as_one_value(spark, tmp_path):
    """One struct in the buffer: the dedup's shuffle holds the key, the struct and its flag."""
    bronze = _bronze_layer(spark, tmp_path)
    for df in (S.to_events(bronze), S.to_pr_events(bronze)):
        assert [len(i.split(",")) for i in _exchange_inputs(df)] == [4]


def test_dedup_takes_one_whole_row_for_a_key_and_drops_rows_without_one(spark):
    rows = [(1, "2024-01-01", "a", 1), (1, "2024-01-01", "b", None), (1, "2024-01-02", None, 2), (1, None, "c", 3), (None, "2024-01-01", "d", 4)]
    df = spark.createDataFrame(rows, "event_id long, event_date string, actor string, n int")
    got = [tuple(r) for r in S.dedup_events(df).collect()]
    assert sorted(r[:2] for r in got if r[1]) == [(1, "2024-01-01"), (1, "2024-01-02")]
    assert len(got) == 3 and set(got) <= set(rows)
    assert S.dedup_events(df.select("event_id", "event_date")).count() == 3


def test_examples_hold_one_line_a_type_instead_of_sorting_the_lines(spark):
    from activity_lake.operators import profiling as PF
    lines = [('{"type":"A","created_at":"2024-01-02","id":"1"}',), ('{"type":"A","created_at":"2024-01-01","id":"3"}',),
             ('{"type":"A","created_at":"2024-01-01","id":"2"}',), ('{"created_at":"2024-01-01","id":"9"}',), ("{broken",)]
    ex = PF.examples(spark.createDataFrame(lines * 3, "value string").selectExpr("value", "'2024-01-01' AS file_date"))
    plan = _formatted(ex)
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert {(r["type"], r["id"], r["json"]) for r in ex.collect()} == {("A", 2, lines[2][0]), (None, 9, lines[3][0])}


def test_bot_flag_and_class_follow_the_dedup(spark, tmp_path):
    """They are functions of the actor: neither sorted nor shuffled with the survivor."""
    bronze = _bronze_layer(spark, tmp_path)
    for df in (S.to_events(bronze), S.to_pr_events(bronze)):
        kept = re.findall(r"first\(struct\([^\n]*", df._jdf.queryExecution().executedPlan().toString())
        assert kept and all("actor_class" not in k and "is_bot" not in k for k in kept)
        assert {"is_bot", "actor_class"} <= set(df.columns)


def test_events_are_counted_by_hash_before_text_is_compared(spark):
    """No aggregate that sorts (its buffer holds text) lies below the first shuffle of the events."""
    from activity_lake.operators import dims, facts
    rows = [(i, f"t{i % 3}", f"a{i % 4}", f"o/r{i % 5}", "2025-01-0%d" % (i % 9 + 1), i % 4 == 0, "human") for i in range(60)]
    ev = spark.createDataFrame(rows + [(60, "t0", "a1", "o/r1", "2025-01-02", None, "zebra"), (61, None, None, None, "2025-01-02", None, "ci_bot")],
                               "event_id long, event_type string, actor string, repo string, event_date string, is_bot boolean, actor_class string")
    ev = ev.withColumn("event_date", ev.event_date.cast("date"))
    actors, months = dims.dim_actor(ev), facts.contributor_month(ev)
    for df in (actors, months):
        plan = df._jdf.queryExecution().executedPlan().toString()
        first = plan[plan.rindex("Exchange hashpartitioning"):]
        assert "HashAggregate" in first and "SortAggregate" not in first, first
    a = {r["actor"]: r for r in actors.collect()}
    assert (a["a1"]["actor_class"], a["a1"]["total_events"], a["a1"]["distinct_repos"]) == ("zebra", 16, 5)
    assert (a[None]["total_events"], a[None]["distinct_repos"]) == (1, 0)
    own = [r for r in rows if r[2] == "a1" and r[3] == "o/r1"]
    m = {(r["actor"], r["repo"]): r for r in months.collect()}[("a1", "o/r1")]
    assert (m["events"], m["distinct_types"], m["actor_class"]) == (len(own) + 1, len({r[1] for r in own} | {"t0"}), "zebra")
    assert m["active_days"] == len({r[4] for r in own} | {"2025-01-02"}) and m["is_first_month"]
