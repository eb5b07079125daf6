"""Parsing, routing and roster rules on hand-written envelopes."""

import json


from pitwall.operators import envelope as E

LAP_MSG = (
    '{"M":[{"A":["TimingData",{"Lines":{"16":{"NumberOfLaps":7,"LastLapTime":{"Value":"1:18.234"}}}},'
    '"2023-05-28T13:03:12.123Z"]}]}'
)
WEATHER_MSG = (
    '{"M":[{"A":["WeatherData",{"AirTemp":"24.1","Humidity":"50.0","Pressure":"1013.2","Rainfall":"0",'
    '"TrackTemp":"40.2","WindDirection":"120","WindSpeed":"1.5"},"2023-05-28T13:03:13.000Z"]}]}'
)
RECAP_MSG = '{"R":{"TimingData":{"Lines":{"16":{"NumberOfLaps":6,"LastLapTime":{"Value":"1:19.001"}}}}}}'
MIXED_MSG = (
    '{"M":[{"A":["TimingData",{"Lines":{"1":{"GapToLeader":"+1.5","IntervalToPositionAhead":{"Value":"+0.4"}},'
    '"44":{"NumberOfLaps":3,"LastLapTime":{"Value":"1:20.000"}}}},"2023-05-28T13:03:14.000Z"]}]}'
)


def _raw(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_classify_kinds(spark):
    raw = _raw(spark, [LAP_MSG, RECAP_MSG, "{}", '{"M":[]}', "no json here", WEATHER_MSG])
    kinds = [r.kind for r in E.classify(raw).collect()]
    assert kinds == ["feed", "recap", "empty", "empty", "text", "feed"]


def test_heartbeats_produce_no_rows(spark):
    raw = _raw(spark, ["{}", '{"M":[]}', "text without brace"])
    assert E.normalise(raw).count() == 0


def test_lap_and_weather_routes(spark):
    lines = E.normalise(_raw(spark, [LAP_MSG, WEATHER_MSG]))
    laps = E.lap_rows(lines).collect()
    assert [(r.PilotNumber, r.Lap, round(r.Seconds, 3)) for r in laps] == [(16, 7, 78.234)]
    w = E.weather_rows(lines).first()
    assert w.Weather.AirTemp == 24.1 and w.Weather.WindDirection == 120 and w.Weather.Rainfall == 0.0


def test_gap_message_scope_vs_line_scope(spark):
    raw = _raw(spark, [MIXED_MSG])
    msg = {r.PilotNumber: r.route for r in E.normalise(raw).collect()}
    assert msg == {1: "gap", 44: "gap"}
    line = {r.PilotNumber: r.route for r in E.normalise(raw, route_scope="line").collect()}
    assert line == {1: "gap", 44: "lap"}
    g = {r.Gaps.PilotNumber: r.Gaps.GapToLeader for r in E.gap_rows(E.normalise(raw)).collect()}
    assert g == {1: 1.5, 44: None}


def test_recap_routes_to_lap_but_yields_no_lap(spark):
    lines = E.normalise(_raw(spark, [RECAP_MSG]))
    assert [r.route for r in lines.collect()] == ["lap"]
    assert E.lap_rows(lines).count() == 0
    assert E.lap_rows(lines, convert_recap=True).first().Seconds == 79.001


def test_missing_lap_count_dropped(spark):
    msg = LAP_MSG.replace('"NumberOfLaps":7,', "")
    assert E.lap_rows(E.normalise(_raw(spark, [msg]))).count() == 0


def test_unconverted_lap_text_dropped_without_error(spark):
    from pitwall.operators.laps import parse_lap_messages

    recs = spark.createDataFrame(
        [('{"TimingData":{"PilotNumber":16,"NumberOfLaps":7,"LastLapTime":{"Value":"1:18.234"}},"@timestamp":"x"}',),
         ('{"TimingData":{"PilotNumber":16,"NumberOfLaps":8,"LastLapTime":{"Value":78.5}},"@timestamp":"x"}',)],
        "value string",
    )
    rows = parse_lap_messages(recs).collect()
    assert [(r.Lap, r.Seconds) for r in rows] == [(8, 78.5)]


def _roster_doc(numbers):
    return json.dumps({"MRData": {"DriverTable": {"Drivers": [{"permanentNumber": n} for n in numbers]}}})


def test_roster_normalise_first_20_and_33(spark):
    nums = ["33"] + [str(i) for i in range(2, 22)]  # 21 entries
    doc = spark.createDataFrame([(_roster_doc(nums),)], "value string")
    pilots = [r.pilot for r in E.roster_numbers(doc).orderBy("pos").collect()]
    assert len(pilots) == 20 and pilots[0] == 1 and "21" not in nums[:20] and 21 not in pilots


def test_unknown_driver_dropped_by_semi_join(spark):
    roster = spark.createDataFrame([(16, 0)], "pilot int, pos int")
    raw = _raw(spark, [LAP_MSG, LAP_MSG.replace('"16"', '"99"'), WEATHER_MSG])
    lines = E.normalise(raw, roster=roster)
    assert sorted((r.route, r.PilotNumber) for r in lines.collect()) == [("lap", 16), ("weather", None)]


def test_best_lap_gate(spark):
    best = LAP_MSG.replace('"NumberOfLaps":7,', '"NumberOfLaps":7,"BestLapTime":{"Value":"1:18.234"},')
    lines = E.normalise(_raw(spark, [LAP_MSG, best]), gate="best_lap")
    assert lines.count() == 1


def test_unknown_fields_survive(spark):
    msg = LAP_MSG.replace('"NumberOfLaps":7', '"NumberOfLaps":7,"Sectors":[1,2]')
    line = E.normalise(_raw(spark, [msg])).first().line_json
    assert '"Sectors":[1,2]' in line


def test_route_is_a_function(spark):
    """Property: every driver line of a message gets exactly one route, and a
    weather message exactly one row (random envelopes)."""
    import random

    rnd = random.Random(5)
    fields = [
        '"NumberOfLaps":%d' % rnd.randint(1, 70),
        '"LastLapTime":{"Value":"1:%02d.%03d"}' % (rnd.randint(0, 59), rnd.randint(0, 999)),
        '"GapToLeader":"+%d.%d"' % (rnd.randint(0, 60), rnd.randint(0, 9)),
        '"Position":"%d"' % rnd.randint(1, 20),
    ]
    msgs, expected = [], 0
    for i in range(300):
        if rnd.random() < 0.2:
            msgs.append('{"M":[{"A":["WeatherData",{"AirTemp":"%d"},"2023-05-28T13:03:%02d.000Z"]}]}' % (i % 40, i % 60))
            expected += 1
            continue
        drivers = rnd.sample(range(1, 99), rnd.randint(1, 4))
        lines = ",".join('"%d":{%s}' % (d, ",".join(rnd.sample(fields, rnd.randint(0, 3)))) for d in drivers)
        if rnd.random() < 0.2:
            msgs.append('{"R":{"TimingData":{"Lines":{%s}}}}' % lines)
        else:
            msgs.append('{"M":[{"A":["TimingData",{"Lines":{%s}},"2023-05-28T13:03:%02d.000Z"]}]}' % (lines, i % 60))
        expected += len(drivers)
    for scope in ("message", "line"):
        rows = E.normalise(_raw(spark, msgs), route_scope=scope).select("route").collect()
        assert len(rows) == expected
        assert {r.route for r in rows} <= {"lap", "gap", "weather", "none"}


def test_typed_outputs_follow_the_data_model(spark):
    from pyspark.sql import functions as F

    from pitwall import schemas
    from pitwall.operators import regress
    from pitwall.operators.laps import pace_order

    lines = E.normalise(_raw(spark, [LAP_MSG, WEATHER_MSG, MIXED_MSG]))
    line_type = lines.schema["line"].dataType
    assert [f.name for f in line_type.fields] == [f.name for f in schemas.TIMING_LINE.fields]
    laps = E.lap_rows(lines)
    assert [(f.name, f.dataType) for f in laps.schema.fields] == [(f.name, f.dataType) for f in schemas.LAP.fields]
    assert E.gap_rows(lines).schema.simpleString() == schemas.GAPS.simpleString()
    assert E.weather_rows(lines).schema.simpleString() == schemas.WEATHER.simpleString()
    pred = regress.rolling_predict(laps).select("PilotN", "NextLap", "prediction", schemas.TS)
    assert [(f.name, f.dataType) for f in pred.schema.fields] == [(f.name, f.dataType) for f in schemas.PREDICTION.fields]
    assert [(f.name, f.dataType) for f in schemas.PREDICTION_INPUT.fields][0][0] == "PilotN"
    ordered = pace_order(laps.withColumn("Seconds", F.col("Seconds"))).collect()
    assert [r.PilotNumber for r in ordered] == [16]


def test_text_that_is_not_json_has_its_own_kind(spark):
    rows = spark.createDataFrame([("{}",), ('{"M":[{"A":',), ("ping",)], "value string")
    assert [r.kind for r in E.classify(rows).collect()] == ["empty", "malformed", "text"]
