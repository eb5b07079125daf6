"""Skew-safe sequencing equals plain per-key windows, across chunks and blocks.

The data has one hot key holding about a third of all rows, and tiny block
sizes so that every halo / carry path is used.
"""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall.operators import regress
from pitwall.plans import sequence as Q


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    eid = 0
    for key in range(12):
        n = 600 if key == 0 else rnd.randint(1, 60)  # key 0 holds about a third
        t = 0
        for _ in range(n):
            t += rnd.randint(0, 3)  # ties in t are broken by eid
            v = None if rnd.random() < 0.3 else round(rnd.uniform(60, 100), 3)
            rows.append((key, t, eid, v))
            eid += 1
    return spark.createDataFrame(rows, "k int, t int, eid long, v double").repartition(5)


def test_size_check_picks_the_plain_window_for_small_keys(skewed):
    assert Q.largest_key(skewed, ["k"]) == 600
    plain = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn")
    assert "repartitionByRange" not in plain._jdf.queryExecution().logical().toString()
    split = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn", max_key_rows=100)
    a = sorted((r.eid, r.rn) for r in plain.select("eid", "rn").collect())
    assert a == sorted((r.eid, r.rn) for r in split.select("eid", "rn").collect())


def test_number_rows_matches_row_number(skewed):
    ours = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn", partitions=7, max_key_rows=None)
    ref = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "eid")))
    a = sorted((r.eid, r.rn) for r in ours.select("eid", "rn").collect())
    b = sorted((r.eid, r.rn) for r in ref.select("eid", "rn").collect())
    assert a == b


def test_hot_key_is_split_across_partitions(skewed):
    laid = skewed.repartitionByRange(7, "k", "t", "eid").withColumn("_p", F.spark_partition_id())
    parts = laid.where("k = 0").select("_p").distinct().count()
    assert parts >= 2


@pytest.mark.parametrize("block_rows", [3, 7, 1 << 20])
def test_lag_lead_across_blocks(skewed, block_rows):
    n = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn", max_key_rows=None)
    ours = Q.lag_lead(n, ["k"], "rn", {"p1": ("eid", 1), "p2": ("eid", 2), "n1": ("eid", -1)}, block_rows)
    w = Window.partitionBy("k").orderBy("rn")
    ref = n.select("eid", F.lag("eid", 1).over(w).alias("p1"), F.lag("eid", 2).over(w).alias("p2"),
                   F.lead("eid", 1).over(w).alias("n1"))
    cols = ["eid", "p1", "p2", "n1"]
    assert sorted(tuple(r) for r in ours.select(*cols).collect()) == sorted(tuple(r) for r in ref.select(*cols).collect())


@pytest.mark.parametrize("block_rows", [4, 50])
def test_carry_forward_across_blocks(skewed, block_rows):
    n = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn", max_key_rows=None)
    b = Q.with_blocks(n, ["k"], "rn", block_rows)
    ours = Q.carry_forward(b, ["k"], "rn", "v", "cf")
    w = Window.partitionBy("k").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    ref = n.select("eid", F.last("v", ignorenulls=True).over(w).alias("cf"))
    assert sorted(tuple(r) for r in ours.select("eid", "cf").collect()) == sorted(tuple(r) for r in ref.collect())


def test_rolling_predict_same_for_any_block_size(skewed):
    laps = skewed.where("v is not null").select(
        F.col("k").alias("PilotNumber"), F.col("t").alias("Lap"), F.col("v").alias("Seconds"), "eid"
    )
    big = regress.rolling_predict(laps, ts="none", tiebreak=("eid",))
    small = regress.rolling_predict(laps, ts="none", tiebreak=("eid",), block_rows=3, max_key_rows=None)
    key = ["PilotN", "Lap", "NextLap"]
    a = sorted((r.PilotN, r.Lap, r.NextLap, round(r.prediction, 9)) for r in big.select(*key, "prediction").collect())
    b = sorted((r.PilotN, r.Lap, r.NextLap, round(r.prediction, 9)) for r in small.select(*key, "prediction").collect())
    assert a == b and len(a) == laps.count()


def test_global_sequence_without_key(skewed):
    """One huge session: no key at all, still split across tasks."""
    n = Q.number_rows(skewed, [], ["k", "t", "eid"], "rn", partitions=6, max_key_rows=None)
    ref = skewed.withColumn("rn", F.row_number().over(Window.orderBy("k", "t", "eid")))
    assert sorted((r.eid, r.rn) for r in n.select("eid", "rn").collect()) == sorted(
        (r.eid, r.rn) for r in ref.select("eid", "rn").collect()
    )
    lagged = Q.lag_lead(n, [], "rn", {"prev": ("eid", 1)}, block_rows=5)
    w = Window.orderBy("rn")
    want = n.select("eid", F.lag("eid", 1).over(w).alias("prev"))
    assert sorted(map(tuple, lagged.select("eid", "prev").collect())) == sorted(map(tuple, want.collect()))


def test_range_partitions_grow_with_the_data(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert Q.range_partitions(spark, None) == base
    assert Q.range_partitions(spark, 10) == base
    assert Q.range_partitions(spark, 100 * Q.RANGE_PARTITION_ROWS + 1) == max(base, 101)


def test_block_shuffle_sized_from_row_count(skewed):
    n = Q.number_rows(skewed, ["k"], ["t", "eid"], "rn", max_key_rows=None)
    b = Q.with_blocks(n, ["k"], "rn", block_rows=50, back=2, longest=600, total_rows=37 * Q.RANGE_PARTITION_ROWS)
    assert b.rdd.getNumPartitions() == 37
    plan = b.withColumn("x", F.lag("eid", 1).over(Q.block_window(["k"], "rn")))._jdf.queryExecution().executedPlan().toString()
    block_exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "_blk" in ln]
    assert len(block_exchanges) == 1 and "REPARTITION_BY_NUM" in block_exchanges[0]  # window reuses it


def test_null_keys_are_kept_on_both_paths(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else i % 2, i) for i in range(60)], "k int, t int")
    plain = Q.number_rows(df, ["k"], ["t"], max_key_rows=1000)
    split = Q.number_rows(df, ["k"], ["t"], max_key_rows=None, partitions=4)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert split.where("k is null").count() == 20
