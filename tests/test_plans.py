"""What the plans must and must not hold."""

import os
from datetime import datetime

import pytest
from check import DATA

from shiftloom.operators.business import RECIPES, Shifts
from shiftloom.operators.ordered import next_value
from shiftloom.plans import QUERIES
from shiftloom.schemas import schema_of
from shiftloom.sources import reads as rd

FOLDER = f"{DATA}/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, key):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan


@needs_data
def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["excursion_episodes"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_date_filter_reaches_the_scan(spark, tmp_path):
    rows = [(1, 0, datetime(2026, 1, 5, 7), datetime(2026, 1, 5, 15), "closed", True, False)]
    spark.createDataFrame(rows, schema_of("executions")).write.parquet(str(tmp_path / "e"))
    temps = spark.createDataFrame([(0, "Primer Turno", "07:00", "15:30", True)], schema_of("templates"))
    shifts = Shifts(spark.read.parquet(str(tmp_path / "e")), temps, RECIPES["detail"], "2026-01-05", "2026-01-06")
    plan = shifts.rows()._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(StartDate,2026-01-05T00:00)" in pushed and "LessThan(EndDate,2026-01-08T00:00)" in pushed
    assert "EqualTo(Status,closed)" in pushed
    assert shifts.rows().count() == 1


def test_sensor_and_day_filters_reach_the_scan(spark, tmp_path):
    row = ("a", 1, 1, datetime(2026, 1, 5, 8), 1.0, None, None, None, None, datetime(2026, 1, 5).date(), "Primer")
    path = rd.write_reads(spark.createDataFrame([row], schema_of("reads")), str(tmp_path / "r"))
    plan = plan_of(rd.load_reads(spark, path, "2026-01-05", shift="Primer").select("Value"))
    assert "PartitionFilters: [isnotnull(Day" in plan and "ReadSchema: struct<Value:double>" in plan


def test_next_value_shuffles_the_rows_once(spark, tmp_path):
    rows = [(i % 3, datetime(2026, 1, 5, i % 24), i) for i in range(200)]
    spark.createDataFrame(rows, "line int, t timestamp_ntz, seq int").write.parquet(str(tmp_path / "s"))
    out = next_value(spark.read.parquet(str(tmp_path / "s")), ["line"], "t", "seq", "t", "after")
    out.collect()
    final = out._jdf.queryExecution().executedPlan()
    assert "ReusedExchange" in final.toString()


def test_aggregates_do_not_sort_their_input(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("benchmark tables are not here")
    plan = plan_of(QUERIES["kpi_fallback"](spark, FOLDER))
    assert "rangepartitioning" not in plan


@needs_data
def test_no_window_over_a_whole_conversation(spark):
    plan = plan_of(QUERIES["message_order"](spark, FOLDER))
    windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert windows and all("_bucket" in line for line in windows)


@needs_data
def test_chart_frames_join_once(spark):
    """The frames read rows that were joined and written before, not the summaries once for each frame."""
    plan = plan_of(QUERIES["chart_frame"](spark, FOLDER))
    assert "Join" not in plan and "lineitem" not in plan
