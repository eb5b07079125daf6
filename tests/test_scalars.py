"""Scalar functions on hand-written edge values (FIXTURES §2)."""

import pytest
from pyspark.sql import functions as F

from pitwall.functions import scalars as S


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_lap_text_to_seconds(spark):
    got = _one(spark, S.lap_text_to_seconds, ["1:18.234", "58.1", "", "x:y", "1:02:03", None])
    assert got[0] == pytest.approx(78.234)
    assert got[1] == pytest.approx(58.1)
    assert got[2] is None and got[3] is None and got[5] is None
    assert got[4] == pytest.approx(62.0)


def test_seconds_to_lap_text_round_trip(spark):
    vals = [78.234, 0.01, 490.02, 59.999, 60.0]
    txt = _one(spark, S.seconds_to_lap_text, vals, "double")
    assert txt[:2] == ["1:18.234", "0:00.010"]
    back = _one(spark, S.lap_text_to_seconds, txt)
    assert back == pytest.approx(vals)


def test_text_to_double(spark):
    got = _one(spark, S.text_to_double, ["+12.345", "1 LAP", "LAP 1", "", "-0.5", None])
    assert got[0] == pytest.approx(12.345)
    assert got[1] == 1.0
    assert got[2] is None and got[3] is None and got[5] is None
    assert got[4] == -0.5


def test_text_to_int(spark):
    assert _one(spark, S.text_to_int, ["120", "12.7", "-3.9", "N/A"]) == [120, 12, -3, None]


def test_clock_number_and_minute_crossing(spark):
    iso = ["2023-05-28T13:00:59.900Z", "2023-05-28T13:01:00.100Z", "2023-05-28T13:03:12Z", "junk"]
    got = _one(spark, S.iso_clock_millis, iso)
    assert got[:3] == [130059900, 130100100, 130312000]
    assert got[3] is None
    # the replayer's clock number jumps 40.2 across the minute -> dropped by P21
    assert (got[1] - got[0]) / 1000.0 == pytest.approx(40.2)


def test_clock_number_rounds_half_up(spark):
    got = _one(spark, S.iso_clock_millis, ["2023-05-28T13:03:12.1235Z", "2023-05-28T13:03:12.1234999Z"])
    assert got == [130312124, 130312123]


def test_literal_payload(spark):
    df = spark.createDataFrame([("{'a': True, 'b': None, 'c':'x'}",)], "v string")
    row = df.select(F.from_json(S.py_literal_to_json(F.col("v")), "a boolean, b string, c string").alias("p")).first()
    assert row.p.a is True and row.p.b is None and row.p.c == "x"


def test_split_points(spark):
    df = spark.createDataFrame([('{"a":{"b":1}}{"R":{}}{"M":[]}',)], "v string")
    parts = df.select(S.json_split_points(F.col("v")).alias("p")).first().p
    assert parts == ['{"a":{"b":1}}', '{"R":{}}', '{"M":[]}']


def test_lap_text_takes_no_type_suffix(spark):
    from pitwall.functions.scalars import lap_text_to_seconds

    rows = spark.createDataFrame([("1:18.2f",), ("58.1d",), ("1:18.2",), ("58.1",)], "t string")
    assert [r[0] for r in rows.select(lap_text_to_seconds("t")).collect()] == [None, None, 78.2, 58.1]
