"""Collections by day under a manifest (S7-S10, P20), streamed panel state
(ST7), sessions (E1), stored predictions (F6, P15), bus options (S1, S2)."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pitwall.operators import dashboard as D
from pitwall.schemas import TS
from pitwall.sources import capture as C
from pitwall.streaming import panels as PN
from pitwall.streaming import predictor as SP
from pitwall.streaming import sinks as SK
from pitwall.streaming import store as ST


def laps(spark, *rows):
    return spark.createDataFrame([(i, 80.0 + i, None if d is None else datetime(2024, 1, d, 12)) for i, d in rows], f"Lap int, Seconds double, `{TS}` timestamp")


def held(store, **kw):
    return sorted(r.Lap for r in store.read(**kw).collect())


def test_a_retried_batch_counts_once(spark, tmp_dir):
    s = ST.CollectionStore(spark, tmp_dir + "/laps")
    assert s.read().count() == 0 and s.compact() == 0
    s.write_batch(laps(spark, (1, 1), (2, 1)), 0)
    s.write_batch(laps(spark, (3, 2)), 1)
    s.write_batch(laps(spark, (3, 2), (4, 2)), 1)  # its first attempt had less
    assert held(s) == [1, 2, 3, 4]
    assert s.compact() == 2 and len(s.manifest().entries) == 1
    s.write_batch(laps(spark, (3, 2), (4, 2)), 1)  # once more, after it was taken in
    assert held(s) == [1, 2, 3, 4]
    s.write_batch(laps(spark, (5, 3)), 2)
    assert held(s) == [1, 2, 3, 4, 5]
    assert s.vacuum() == 3 and held(s) == [1, 2, 3, 4, 5]


def test_compaction_killed_half_way_changes_nothing(spark, tmp_dir, monkeypatch):
    s = ST.CollectionStore(spark, tmp_dir + "/laps")
    for b in range(4):
        s.write_batch(laps(spark, (b, 1 + b % 2)), b)
    before = s.manifest()

    def killed(self, change):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ST.CollectionStore, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            s.compact()
    assert s.manifest() == before and held(s) == [0, 1, 2, 3]
    assert s.compact() == 4 and held(s) == [0, 1, 2, 3]
    assert s.vacuum() == 5  # four taken in, one that never counted


def test_a_batch_written_while_compacting_is_kept(spark, tmp_dir, monkeypatch):
    s, other = (ST.CollectionStore(spark, tmp_dir + "/laps") for _ in range(2))
    for b in range(2):
        s.write_batch(laps(spark, (b, 1)), b)
    commit = ST.CollectionStore._commit

    def slow(self, change):
        if self is s:
            other.write_batch(laps(spark, (9, 2)), 9)
        return commit(self, change)

    with monkeypatch.context() as m:
        m.setattr(ST.CollectionStore, "_commit", slow)
        assert s.compact() == 2
    assert held(s) == [0, 1, 9] and sorted(map(tuple, s.manifest().entries.values())) == [(0, 1), (9,)]
    # entries that another compaction took meanwhile: this one gives up
    with monkeypatch.context() as m:
        m.setattr(ST.CollectionStore, "_commit", lambda self, change: (other_compacts(other, commit), commit(self, change))[1] if self is s else commit(self, change))
        with pytest.raises(ST.CommitConflict):
            s.compact()
    assert held(s) == [0, 1, 9]


def other_compacts(other, commit):
    if len(other.manifest().entries) > 1:
        other.compact()


def test_time_range_prunes_days_and_row_groups(spark, tmp_dir):
    s = ST.CollectionStore(spark, tmp_dir + "/laps")
    s.write_batch(laps(spark, (1, 1), (2, 2), (3, 3), (4, None)), 0)
    s.write_batch(laps(spark, (5, 2), (6, 4)), 1)
    lo, hi = datetime(2024, 1, 2), datetime(2024, 1, 3)
    for _ in range(2):
        assert held(s, lo=lo, hi=hi) == [2, 5] and held(s) == [1, 2, 3, 4, 5, 6]
        plan = s.read(lo, hi)._jdf.queryExecution().executedPlan().toString().replace("`", "")
        assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(@timestamp), GreaterThanOrEqual(@timestamp" in plan
        s.compact()
    assert s.read(lo, hi).inputFiles() and len(s.read().inputFiles()) >= 4


def test_columns_that_come_later_are_null_before(spark, tmp_dir):
    s = ST.CollectionStore(spark, tmp_dir + "/laps")
    s.write_batch(laps(spark, (1, 1)), 0)
    s.write_batch(laps(spark, (2, 1)).withColumn("session", F.lit("a")), 1)
    assert sorted((r.Lap, r.session) for r in s.read().collect()) == [(1, None), (2, "a")]


def test_panel_state_merges_updates_in_any_order_and_number(spark):
    rows = [(p, lap, 80.0 + (p * lap) % 7, datetime(2024, 1, 1, lap % 24, p), p * 100 + lap) for p in range(40) for lap in range(1, 60)]
    rows += [(1, 5, None, datetime(2024, 2, 1), 9999), (None, 3, 1.0, datetime(2024, 2, 1), 9998)]
    df = spark.createDataFrame(rows, f"PilotNumber int, Lap int, Seconds double, `{TS}` timestamp, event_id long")
    parts = [PN.state(df.where(F.col("event_id") % 3 == i), PN.RACE_PACE, ["event_id"]) for i in range(3)]
    updates = parts[2].unionByName(parts[0]).unionByName(parts[1]).unionByName(parts[0])  # out of order, one twice
    states = PN.merged(updates, PN.RACE_PACE)
    assert states.count() == 40 * 59  # one row for each unit bucket
    assert sorted(map(tuple, PN.table(states, PN.RACE_PACE).collect())) == sorted(map(tuple, D.race_pace_table(df, ["event_id"]).collect()))
    assert PN.latest(spark.createDataFrame([], ", ".join(f"{v} double, {v}_at long" for v in PN.WEATHER.values))).count() == 1


def test_streamed_state_has_one_row_for_each_unit_bucket(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    kind = f"PilotNumber int, Lap int, Seconds double, `{TS}` timestamp"
    sizes = []
    for wave in range(3):
        spark.createDataFrame([(p, lap, 80.0 + wave, datetime(2024, 1, 1 + wave)) for p in (1, 2) for lap in range(1, 6)], kind).coalesce(1).write.mode("append").parquet(src)
        q = (
            PN.state(spark.readStream.schema(kind).parquet(src), PN.RACE_PACE).writeStream.outputMode("update")
            .option("checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).foreachBatch(SK.batch_writer(f"{root}/{PN.RACE_PACE.name}")).start()
        )
        q.awaitTermination()
        sizes.append(sum(o.numRowsTotal for p in q.recentProgress[-1:] for o in p.stateOperators))
    assert sizes == [10, 10, 10]
    states = PN.merged(PN.read(spark, root, PN.RACE_PACE), PN.RACE_PACE)
    assert sorted((r.pilot, r.x, r.seconds) for r in states.collect()) == [(p, lap, 82.0) for p in (1, 2) for lap in range(1, 6)]


def test_the_same_car_in_two_captures_is_two_drivers(spark, tmp_dir):
    line = lambda lap, sec: json.dumps({"M": [{"A": ["TimingData", {"Lines": {"16": {"NumberOfLaps": lap, "LastLapTime": {"Value": f"1:{sec:06.3f}"}}}}, f"2024-01-01T00:{lap:02d}:00.000Z"]}]})
    for name, base in (("monza", 20.0), ("spa", 45.0)):
        os.makedirs(f"{tmp_dir}/feed/{name}")
        with open(f"{tmp_dir}/feed/{name}/capture.txt", "w") as f:
            f.write("\n".join(line(lap, base) for lap in range(1, 9)) + "\n")
    raw = C.read_lines(spark, tmp_dir + "/feed", stream=True, sessions=True)
    with SP.use_rocksdb(spark):
        for q in SK.start_live(raw, tmp_dir + "/out", tmp_dir + "/ck", documents=True):
            q.awaitTermination()
    pred = spark.read.parquet(f"{tmp_dir}/out/{SK.PREDICTIONS_TABLE}")
    assert dict(pred.dtypes)["prediction"] == "float" and {TS, SK.STAMP} <= set(pred.columns)
    got = {(r.session, r.NextLap): round(r.prediction, 2) for r in pred.collect()}
    assert got == {(s, n): v for s, v in (("monza", 80.0), ("spa", 105.0)) for n in range(2, 10)}
    assert {r.session for r in spark.read.parquet(f"{tmp_dir}/out/{SK.LAPS_TABLE}").collect()} == {"monza", "spa"}


def test_prediction_documents_share_one_processing_time(spark):
    pred = spark.range(100, numPartitions=7).select(F.col("id").alias("PilotN"), F.lit(1).alias("Lap"), F.lit(2).alias("NextLap"), F.lit(80.123456789).alias("prediction"), F.lit(None).cast("timestamp").alias(TS))
    rows = SK.prediction_documents(pred).collect()
    assert len({r[SK.STAMP] for r in rows}) == 1 and rows[0].prediction == pytest.approx(80.123456789, abs=1e-5) and rows[0].prediction != 80.123456789
