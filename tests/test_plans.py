"""Physical-plan properties the scale design relies on."""

import pytest

from tidepool.plans import dims, marts
from tidepool.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


READ_ONLY = [n for n in sorted(QUERIES) if n not in {
    "q_raw_roundtrip", "q_snapshot_replace", "q_csv_format_scan", "q_stage_load", "q_load_verify",
    "q_batch_audit", "q_gate_publish", "q_end_to_end_run", "q_extract_checks", "q_test_not_null", "q_test_unique",
    "q_test_accepted_values", "q_test_suite", "q_catalog_mart", "q_resume_batch", "q_bad_cells"}]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_python_in_any_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert op not in plan, (name, op)


def test_latest_row_dedup_limits_before_the_shuffle(spark):
    plan = _plan(QUERIES["q_customer_latest"](spark, SF))
    final = plan.index("row_number(), 1, Final")
    exchange = plan.index("Exchange hashpartitioning(customer_phone")
    partial = plan.index("row_number(), 1, Partial")
    # the tree prints top-down: the map-side (Partial) limit sits below the shuffle
    assert final < exchange < partial


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_job_runs_while_a_query_is_built(spark, name):
    tracker, group = spark.sparkContext.statusTracker(), f"build-{name}"
    QUERIES[name](spark, SF)                       # opens the tables: their footers are read once per session
    spark.sparkContext.setJobGroup(group, "building a plan")
    try:
        QUERIES[name](spark, SF)
        assert tracker.getJobIdsForGroup(group) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_daily_mart_reads_orders_only(spark):
    plan = _plan(QUERIES["q_mart_revenue_daily"](spark, SF))
    assert "BroadcastHashJoin" in plan and "orders.parquet" in plan
    assert "lineitem.parquet" not in plan and "events.parquet" not in plan


def test_calendar_of_any_declared_length_is_broadcast(spark):
    fact = spark.createDataFrame([(20200101, "s", 1, 1, 1)],
                                 "date_key int, source string, gross_amount long, discount_amount long, net_amount long")
    for days in (10, 3650, 3_000_000):
        assert "BroadcastHashJoin" in _plan(marts.mart_revenue_daily(fact, dims.dim_date(spark, "1900-01-01", days)))


def test_bindings_prune_columns(spark):
    text = _explain(QUERIES["q_check_accepted_values"](spark, SF))
    assert "ReadSchema" in text
    from tidepool.sources.bindings import bind
    plan = _plan(bind(spark, SF, "reviews"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_marts_aggregate_partially_before_shuffle(spark):
    for q in ("q_mart_revenue_daily", "q_mart_customer_analytics", "q_mart_product_analytics",
              "q_mart_treatment_analytics", "q_mart_operations_booking"):
        plan = _plan(QUERIES[q](spark, SF))
        assert "partial_" in plan, q


def test_operations_mart_joins_the_bookings(spark):
    plan = _plan(QUERIES["q_mart_operations_booking"](spark, SF))
    assert plan.count("events.parquet") == 2 and plan.count("SortMergeJoin") == 2   # J1 and J4


def test_row_level_tests_do_not_shuffle_values(spark):
    from tidepool.operators import constraints
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "id long, s string")
    specs = [("", "m", "id", "not_null", None), ("", "m", "id", "unique", None), ("", "m", "s", "unique", None),
             ("", "m", "s", "accepted_values", ["a"])]
    rows = constraints.run_suite(spark, {"m": df}, specs, kinds=("not_null", "accepted_values"))
    assert "Exchange hashpartitioning" not in _plan(rows)
    got = {(r.column_name, r.test): r.failing_rows for r in constraints.run_suite(spark, {"m": df}, specs).collect()}
    # "a" is on two rows: one repeated value
    assert got == {("id", "not_null"): 1, ("id", "unique"): 0, ("s", "unique"): 1, ("s", "accepted_values"): 1}


def test_gate_is_single_pass(spark):
    from tidepool.operators import quality
    df = spark.createDataFrame([(i, i % 7) for i in range(100)], "id long, v long")
    rules = {"columns": ["id", "v"], "not_null": ["id"], "unique": ["id"],
             "checks": [{"type": "min_value", "column": "v", "min": 1}]}
    plan = _plan(quality.gate(df, "t", rules))
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1   # the batch is read once
    assert plan.count("Exchange") == 2   # keys, then the single-row fold


def test_broadcasts_come_from_measured_sizes(spark):
    """No estimate-based broadcast in the initial plan; AQE broadcasts the members side
    of dim_customer only after measuring it."""
    df = QUERIES["q_dim_customer"](spark, SF)
    initial = _plan(df)
    assert "SortMergeJoin" in initial and "BroadcastHashJoin" not in initial
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final
