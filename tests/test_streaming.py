"""ST1-ST8: keyed-state predictor over a file stream, split and bronze sinks."""

import json
import os

import pytest

from pitwall.config import scratch_path
from pitwall.operators.laps import parse_lap_messages
from pitwall.sources import capture as C
from pitwall.streaming import predictor as SP
from pitwall.streaming import sinks as SK


def _msg(pilot, lap, sec, ts):
    return json.dumps({"TimingData": {"PilotNumber": pilot, "NumberOfLaps": lap, "LastLapTime": {"Value": sec}},
                       "@timestamp": ts})


class LapStream:
    """A file stream that receives one file per call and runs availableNow."""

    def __init__(self, spark, tmp_dir):
        self.spark, self.src = spark, os.path.join(tmp_dir, "src")
        os.makedirs(self.src)
        self.out, self.ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
        self.files = 0

    def push(self, lines):
        with open(os.path.join(self.src, f"f{self.files:03d}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        self.files += 1
        laps = parse_lap_messages(C.read_lines(self.spark, self.src, stream=True, max_files=1))
        with SP.use_rocksdb(self.spark):
            SK.run_available(SP.predict_stream(laps), self.ck, fn=SK.batch_writer(self.out))
        return sorted(
            (r.batch_id, r.Lap, r.NextLap, r.prediction) for r in self.spark.read.parquet(self.out).collect()
        )


def test_late_lap_never_lowers_next_lap(spark, tmp_dir):
    s = LapStream(spark, tmp_dir)
    for i, lap in enumerate([1, 2, 4, 3]):
        rows = s.push([_msg(16, lap, 80.0 + lap, f"2024-01-01T00:0{i}:00Z")])
    assert [r[2] for r in rows] == [2, 3, 5, 5]


def test_two_laps_in_one_batch_each_appended_once(spark, tmp_dir):
    s = LapStream(spark, tmp_dir)
    rows = s.push([_msg(7, 1, 90.0, "2024-01-01T00:01:00Z"), _msg(7, 2, 92.0, "2024-01-01T00:02:00Z")])
    assert [(r[1], r[2]) for r in rows] == [(1, 2), (2, 3)]
    # lap 2 (next 3, refit since < 6) fits exactly the two laps: slope 2/(1+0.01/1)
    slope = 2.0 / (1 + 0.01 / 1.0)
    assert rows[1][3] == pytest.approx((91.0 - slope * 1.5) + slope * 3)
    rows = s.push([_msg(7, 3, 94.0, "2024-01-01T00:03:00Z")])
    assert len(rows) == 3  # state carried, nothing duplicated


def test_buffer_is_bounded(spark, tmp_dir):
    s = LapStream(spark, tmp_dir)
    s.push([_msg(5, lap, 80.0, f"2024-01-01T00:{lap:02d}:00Z") for lap in range(1, 31)])
    rows = s.push([_msg(5, 31, 80.0, "2024-01-01T00:31:00Z")])
    assert rows[-1][2] == 32 and rows[-1][3] == pytest.approx(80.0)


def test_three_way_split_and_bronze(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw")
    os.makedirs(src)
    lines = [
        '{"M":[{"A":["TimingData",{"Lines":{"16":{"NumberOfLaps":7,"LastLapTime":{"Value":"1:18.234"}}}},"2023-05-28T13:03:12.123Z"]}]}',
        '{"M":[{"A":["WeatherData",{"AirTemp":"24.1"},"2023-05-28T13:03:13.000Z"]}]}',
        '{"M":[{"A":["TimingData",{"Lines":{"1":{"GapToLeader":"+1.5"}}},"2023-05-28T13:03:14.000Z"]}]}',
        "{}",
    ]
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    root = scratch_path(spark, "t-split")
    raw = C.read_lines(spark, src, stream=True)
    SK.run_available(raw, scratch_path(spark, "t-split-ck"), fn=SK.three_way_split(root))
    counts = {t: spark.read.parquet(f"{root}/{t}").count() for t in (SK.LAPS_TABLE, SK.GAPS_TABLE, SK.WEATHER_TABLE)}
    assert counts == {"lastlaptimes": 1, "gaps": 1, "others": 1}
    out = scratch_path(spark, "t-bronze")
    SK.run_available(SK.bronze(C.read_lines(spark, src, stream=True)), scratch_path(spark, "t-bronze-ck"), path=out)
    assert spark.read.parquet(out).count() == 3


def test_start_live_equals_batch(spark, tmp_dir):
    from pyspark.sql import functions as F

    from pitwall.operators import envelope as E
    from pitwall.operators import regress
    from pitwall.sources import derived as V

    ev = V.load(spark, "/root/testdata/sf0.001", "events")
    src = os.path.join(tmp_dir, "feed")
    C.write_lines(V.feed_messages(ev), src)
    root, ck = scratch_path(spark, "t-live"), scratch_path(spark, "t-live-ck")
    raw = C.read_lines(spark, src, stream=True)
    with SP.use_rocksdb(spark):
        for q in SK.start_live(raw, root, ck):
            q.awaitTermination()
    got = spark.read.parquet(f"{root}/{SK.PREDICTIONS_TABLE}").select("PilotN", "Lap", F.round("prediction", 6).alias("p"))
    batch_laps = E.lap_rows(E.normalise(V.feed_messages(ev)))
    want = regress.rolling_predict(batch_laps).select("PilotN", "Lap", F.round("prediction", 6).alias("p"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(f"{root}/{SK.LAPS_TABLE}").count() == batch_laps.count()
    assert spark.read.parquet(f"{root}/bronze").count() == ev.count()


def test_predictor_with_session_key(spark, tmp_dir):
    src = os.path.join(tmp_dir, "s")
    os.makedirs(src)
    lines = [json.dumps({"session": s, "TimingData": {"PilotNumber": 4, "NumberOfLaps": lap, "LastLapTime": {"Value": 80.0 + s * lap}},
                         "@timestamp": f"2024-01-01T00:{lap:02d}:00Z"}) for s in (1, 2) for lap in range(1, 8)]
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    from pyspark.sql import functions as F

    raw = C.read_lines(spark, src, stream=True)
    laps = parse_lap_messages(raw.withColumn("session", F.get_json_object("value", "$.session").cast("int")))
    out = scratch_path(spark, "t-sess")
    with SP.use_rocksdb(spark):
        SK.run_available(SP.predict_stream(laps, key=["session", "PilotNumber"]), scratch_path(spark, "t-sess-ck"),
                         fn=SK.batch_writer(out))
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 14 and {r.session for r in rows} == {1, 2}
    # each session is its own sequence: the prediction follows its own slope
    last = {r.session: r.prediction for r in rows if r.Lap == 7}
    assert last[2] > last[1]


def test_dashboards_over_live_collections(spark, tmp_dir):
    from pitwall.operators import dashboard as D
    from pitwall.sources import derived as V

    ev = V.load(spark, "/root/testdata/sf0.001", "events")
    src = os.path.join(tmp_dir, "feed")
    C.write_lines(V.feed_messages(ev), src)
    root, ck = scratch_path(spark, "t-dash"), scratch_path(spark, "t-dash-ck")
    with SP.use_rocksdb(spark):
        for q in SK.start_live(C.read_lines(spark, src, stream=True), root, ck):
            q.awaitTermination()
    col = SK.read_collections(spark, root)
    n_laps = ev.where("event_type in ('click', 'view')").count()
    assert D.pace_trace(col["laps"]).count() == n_laps
    assert D.race_lap(col["laps"]).first().race_lap is not None
    assert D.race_pace_table(col["laps"]).count() > 0
    assert D.prediction_table(col["predictions"]).count() > 0
    assert D.gap_bars(col["gaps"]).count() > 0
    assert D.weather_latest(col["weather"]).first().AirTemp is not None
    u = D.unified_view(col["laps"], col["predictions"], col["gaps"], col["weather"])
    assert u.count() == 2 * n_laps + ev.where("event_type in ('purchase', 'error')").count()


def test_command_line_live_and_dashboards(spark, tmp_dir):
    from pitwall import __main__ as cli
    from pitwall.sources import derived as V

    ev = V.load(spark, "/root/testdata/sf0.001", "events")
    feed = os.path.join(tmp_dir, "feed")
    from pyspark.sql import functions as F

    files = V.feed_messages(ev).withColumn("f", F.floor(F.col("event_id") / 300))
    C.write_concatenated(files, feed, ["event_id"], "f")
    out = scratch_path(spark, "t-cli")
    cli.live(spark, feed, out, concatenated=True)
    panels = cli.dashboards(spark, out)
    assert set(panels) == {"pace_trace", "race_pace_table", "race_lap", "gap_bars", "weather_latest", "prediction_table"}
    assert panels["race_lap"].first().race_lap is not None
    assert panels["pace_trace"].count() == ev.where("event_type in ('click', 'view')").count()


def test_restart_goes_on_where_it_ended(spark, tmp_dir):
    from pitwall import __main__ as cli
    from pitwall.sources import derived as V

    ev = V.load(spark, "/root/testdata/sf0.001", "events")
    early = ev.agg({"event_id": "max"}).first()[0] // 2
    feed, whole = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "whole")
    out, once = scratch_path(spark, "t-restart"), scratch_path(spark, "t-once")
    for part in (ev.where(f"event_id <= {early}"), ev.where(f"event_id > {early}")):
        for folder in (feed, whole):
            V.feed_messages(part).select("value").write.mode("append").text(folder)
        cli.live(spark, feed, out)
    cli.live(spark, whole, once)
    a, b = SK.read_collections(spark, out), SK.read_collections(spark, once)
    for name in ("laps", "gaps", "weather", "predictions"):
        assert a[name].count() == b[name].count() > 0, name
    assert spark.read.parquet(f"{out}/bronze").count() == spark.read.parquet(f"{once}/bronze").count()


def test_repeated_lap_follows_the_batch_rule(spark, tmp_dir):
    from pitwall.operators import regress

    s = LapStream(spark, tmp_dir)
    times = [(1, 80.0), (2, 81.0), (2, 99.0), *[(lap, 80.0 + lap) for lap in range(3, 12)]]
    lines = [_msg(16, lap, sec, f"2024-01-01T00:{i:02d}:00Z") for i, (lap, sec) in enumerate(times)]
    s.push(lines[:3])
    got = {(r[2], round(r[3], 6)) for r in s.push(lines[3:])}
    laps = parse_lap_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    want = {(r.NextLap, round(r.prediction, 6)) for r in regress.rolling_predict(laps).collect()}
    assert got == want


class _Handle:
    """A state store of one key that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def _shard_batches():
    import numpy as np
    import pandas as pd

    rng, at = np.random.default_rng(5), pd.Timestamp("2024-01-01")
    for drivers in ([3, 1, 2], [2, 4], [1, 5, 3, 4], [2], [1, 2, 3, 4, 5]):
        rows = [(d, int(rng.integers(1, 30)), float(rng.normal(80, 5)), at + pd.Timedelta(seconds=int(rng.integers(0, 40)))) for d in drivers for _ in range(int(rng.integers(1, 14)))]
        yield pd.DataFrame(rows, columns=["PilotNumber", "Lap", "Seconds", "ts"]).sample(frac=1, random_state=1)
        at += pd.Timedelta(minutes=1)


def test_drivers_of_a_shard_share_one_read_and_one_write_of_the_state():
    """The calls to the state store follow the shards, not the drivers;
    each driver gets what a predictor of its own gives."""
    import pandas as pd

    def made():
        p, h = SP.RollingPredictor(), _Handle()
        p.init(h)
        return p, h

    def run(p, rows):
        return pd.concat(p.handleInputRows((0,), iter([rows.reset_index(drop=True)]), None))

    (shard, store), own = made(), {d: made()[0] for d in range(1, 6)}
    for turn, rows in enumerate(_shard_batches(), 1):
        got = run(shard, rows)
        assert store.calls == 2 * turn
        want = pd.concat([run(own[d], part) for d, part in rows.groupby("PilotNumber")])
        by = ["PilotN", "ts", "Lap", "NextLap", "prediction"]
        got, want = (x.sort_values(by).reset_index(drop=True) for x in (got, want))
        pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-12)


def test_sharded_predictor_equals_the_batch_predictor(spark, tmp_dir):
    from pitwall.operators.regress import rolling_predict

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out, ck = scratch_path(spark, "t-shard"), scratch_path(spark, "t-shard-ck")
    lap = 0
    for i in range(3):
        with open(os.path.join(src, f"f{i}.txt"), "w") as f:
            for _ in range(5):
                lap += 1
                for pilot in range(1, 8):
                    if (pilot + i) % 3:  # some have no lap in a batch
                        f.write(_msg(pilot, lap, 80.0 + (pilot * lap) % 7, f"2024-01-01T00:{lap:02d}:{pilot:02d}Z") + "\n")
        laps = parse_lap_messages(C.read_lines(spark, src, stream=True, max_files=1))
        with SP.use_rocksdb(spark):
            SK.run_available(SP.predict_stream(laps, shards=2), ck, fn=SK.batch_writer(out))
    cols = ["PilotN", "Lap", "NextLap"]
    got = {tuple(r[:3]): r[3] for r in spark.read.parquet(out).select(*cols, "prediction").collect()}
    want = rolling_predict(parse_lap_messages(C.read_lines(spark, src)), order="arrival", tiebreak=("Lap",))
    want = {tuple(r[:3]): r[3] for r in want.select(*cols, "prediction").collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
