"""W2/P21 pacing and D1-D6 / W4 dashboard semantics on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwall.operators import dashboard as D
from pitwall.operators import pacing as P
from pitwall.schemas import TS

T0 = dt.datetime(2023, 5, 28, 13, 0, 0)


def _msgs(spark, offsets):
    rows = [(i, 1, T0 + dt.timedelta(seconds=o)) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "event_id long, session int, `@timestamp` timestamp")


def test_feed_deltas_kept_only_in_0_10(spark):
    # deltas 0, 0.5, 10, 10.1, -1 after the first message
    offsets = [0, 0, 0.5, 10.5, 20.6, 19.6]
    d = P.interarrival(_msgs(spark, offsets), ["session"], TS, order=["event_id"])
    kept = P.bounded_gap_filter(d).orderBy("event_id").collect()
    assert [r.delta for r in kept] == [0.5, 10.0]


def test_clock_mode_minute_crossing_dropped(spark):
    rows = [(0, 1, "2023-05-28T13:00:59.900Z"), (1, 1, "2023-05-28T13:01:00.100Z")]
    df = spark.createDataFrame(rows, "event_id long, session int, iso string").withColumn(TS, F.to_timestamp("iso"))
    d = P.interarrival(df, ["session"], TS, order=["event_id"], mode="clock", iso_text="iso")
    deltas = [r.delta for r in d.orderBy("event_id").collect()]
    assert deltas[0] is None and deltas[1] == pytest.approx(40.2)
    assert P.bounded_gap_filter(d).count() == 0
    t = P.interarrival(df, ["session"], TS, order=["event_id"])
    assert P.bounded_gap_filter(t).count() == 1


def test_nice_interval():
    assert [D.nice_interval(s, 167.5) for s in (0, 85, 149, 1499)] == [1, 1, 1, 10]
    assert D.nice_interval(149, 100) == 2
    assert D.nice_interval(85, 1) == 100
    assert D.nice_interval(None, 1) == 1


def test_race_lap_empty_is_null(spark):
    empty = spark.createDataFrame([], "PilotNumber int, Lap int, Seconds double, `@timestamp` timestamp")
    assert D.race_lap(empty).first().race_lap is None


def test_last_value_skips_missing(spark):
    rows = [(1, 1, 80.0, T0), (1, 2, None, T0 + dt.timedelta(seconds=5)), (1, 3, 79.0, T0 + dt.timedelta(seconds=2))]
    df = spark.createDataFrame(rows, "PilotNumber int, Lap int, Seconds double, `@timestamp` timestamp")
    got = df.groupBy("PilotNumber").agg(D.last_value("Seconds").alias("s")).first().s
    assert got == 79.0


@pytest.mark.parametrize("block_rows", [2, 1 << 20])
def test_linear_fill(spark, block_rows):
    rows = [(1, 3, 90.0), (1, 6, 93.0), (1, 12, 81.0), (2, 5, 70.0)]
    df = spark.createDataFrame(rows, "PilotNumber int, Lap int, Seconds double")
    got = {(r.PilotNumber, r.Lap): r.Seconds for r in D.linear_fill(df, block_rows=block_rows).collect()}
    assert len(got) == 10 + 1
    assert got[(1, 4)] == pytest.approx(91.0) and got[(1, 9)] == pytest.approx(87.0)
    assert got[(1, 12)] == 81.0 and got[(2, 5)] == 70.0


def test_weather_and_gaps_latest(spark):
    w = spark.createDataFrame(
        [((20.0, 50.0, 1000.0, 0.0, 30.0, 90, 1.0), T0), ((None, 55.0, 1001.0, 1.0, 31.0, 95, 2.0), T0 + dt.timedelta(seconds=1))],
        "Weather struct<AirTemp:double,Humidity:double,Pressure:double,Rainfall:double,TrackTemp:double,"
        "WindDirection:int,WindSpeed:double>, `@timestamp` timestamp",
    )
    r = D.weather_latest(w).first()
    assert (r.AirTemp, r.Humidity, r.Rainfall) == (20.0, 55.0, 1.0)
