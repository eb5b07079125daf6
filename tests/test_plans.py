"""Physical-plan properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pitwall.catalog import QUERIES
from pitwall.operators import laps as L
from pitwall.sources import derived as V

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_one_shuffle_with_pruned_scan(spark):
    plan = _plan(entry.queries()["rolling_lap_prediction"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan


def test_lap_buffer_limits_rows_before_the_shuffle(spark):
    ev = V.load(spark, SF, "events")
    laps = ev.select(F.col("user_id").alias("PilotNumber"), F.col("event_id").alias("Lap"), F.col("value").alias("Seconds"))
    plan = L.lap_buffer(laps, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["pace_trace", "gap_bars", "race_pace_table"])
def test_dashboard_aggregates_partially_before_shuffle(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "partial_max_by" in plan


def test_roster_is_broadcast(spark):
    plan = _plan(entry.queries()["line_fanout"](spark, SF))
    assert "BroadcastHashJoin" in plan


def test_no_python_udf_in_batch_queries(spark):
    for name, q in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


@pytest.mark.parametrize("name", ["pace_trace", "gap_bars", "race_pace_table", "prediction_table"])
def test_last_value_is_a_hash_aggregate(spark, name):
    assert "SortAggregate" not in _plan(entry.queries()[name](spark, SF))


def test_bus_laps_are_parsed_once(spark):
    plan = entry.queries()["parse_lap_value"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan


def test_best_lap_gate_parses_once(spark):
    plan = entry.queries()["best_lap_gate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") <= 1
