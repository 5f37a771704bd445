"""What the plans must look like to hold at scale."""

import os

import pytest

from tickweave import storage
from tickweave.operators import dedup
from tickweave.plans import catalog

QUERIES = catalog.queries()


def plan_of(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_symbol", "EqualTo(event_type,purchase)"),
        ("filter_symbols", "In(event_type, [click,purchase]"),
        ("filter_time_range", "GreaterThanOrEqual(ts,2024-01-08T00:00)"),
        ("filter_time_range", "LessThanOrEqual(ts,2024-01-19T12:30:45)"),
        ("incremental_load", "IsNotNull(ts), In(event_type"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in plan_of(spark, sf_dir, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("ingest_millis", "struct<event_id:bigint,event_type:string>"),
        ("page_count", "struct<l_returnflag:string>"),
        ("bitmap_counts", "struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>"),
        ("distinct_securities", "struct<p_partkey:bigint>"),
        ("cycle_log", "struct<event_id:bigint,ts:timestamp_ntz,event_type:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(spark, sf_dir, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_operator_that_does_not_scale(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert bad not in plan


def test_incremental_load_moves_the_trades_once(spark, sf_dir):
    """De-duplication places rows by key, and the anti-join uses that."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, sf_dir, "incremental_load")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


# Large enough that the pages are not empty.
PAGED = "/root/testdata/sf0.01"


def test_pages_are_a_top_k(spark):
    for name in ("latest_trades", "latest_trades_symbol", "trades_range_page"):
        assert "TakeOrderedAndProject" in plan_of(spark, PAGED, name)


def test_a_located_page_reads_its_hours_only(spark):
    plan = plan_of(spark, PAGED, "trades_page")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_the_seen_set_orders_no_instrument(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "bounded_seen_set")
    assert "Window" not in plan and "Exchange hashpartitioning(secid" not in plan


def test_bitmaps_take_one_shuffle(spark):
    keys = spark.range(1000).selectExpr("string(id % 3) AS secid", "id AS tradeno")
    plan = dedup.seen_bitmaps(keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange") :]
    assert "partial_collect_set" in below


def test_no_instrument_is_numbered_in_one_task(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "page_assignment")
    assert "row_number()" not in plan
    assert "hashpartitioning(secid" in plan and "_piece" in plan


def test_each_response_is_parsed_once(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "list_securities")
    assert plan.count("from_json(") == 1


def test_initial_load_moves_nothing(spark, sf_dir):
    assert "Exchange" not in plan_of(spark, sf_dir, "initial_load")


def test_cycle_log_reads_each_table_once(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "cycle_log")
    assert plan.count("FileScan") == 2  # the trades, and the keys seen before


def test_a_table_of_symbols_is_computed_once(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "filter_symbols_table")
    assert plan.count("events.parquet") == 1 and "BroadcastHashJoin" in plan


def test_staged_tables_are_released(spark):
    path = storage.scratch(spark, "x").rsplit("/", 1)[0]
    assert storage.stage(spark.range(3), "x").count() == 3
    assert os.listdir(path)
    storage.release(spark)
    assert not os.path.exists(path)
