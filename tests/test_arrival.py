"""ST6: laps in arrival order, batch and stream state, against a plain loop."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.operators import arrival, regress
from pitwall.streaming import predictor

T0 = datetime(2024, 5, 1, 12, 0, 0)


def late_laps(drivers=3, laps=40, seed=3):
    """Laps that come late, twice, and at equal times."""
    rnd = random.Random(seed)
    rows = []
    for d in range(drivers):
        order = list(range(1, laps + 1))
        for _ in range(laps // 3):
            i = rnd.randrange(laps - 1)
            j = min(laps - 1, i + rnd.randrange(1, 9))
            order[i], order[j] = order[j], order[i]
        order += rnd.choices(order, k=5)
        for k, lap in enumerate(order):
            rows.append((d, lap, round(80 + rnd.random() * 5, 3), T0 + timedelta(seconds=k - k % 7 // 6), len(rows)))
    return rows


def by_loop(rows, n, cadence, reg=0.01):
    out = {}
    for d in {r[0] for r in rows}:
        seen, model, first = [], None, True
        for _, lap, sec, at, i in sorted((r for r in rows if r[0] == d), key=lambda r: (r[3], r[1], r[4])):
            seen.append((lap, at, len(seen), sec))
            top = sorted(seen, reverse=True)[:n]
            nxt = top[0][0] + 1
            if nxt % cadence == 0 or nxt < 6 or first:
                x, y = np.array([t[0] for t in top], float), np.array([t[3] for t in top])
                vx, sy = x.var(), y.std()
                slope = ((x - x.mean()) * (y - y.mean())).mean() / vx / (1 + reg / sy) if vx > 0 and sy > 0 else 0.0
                model, first = (slope, y.mean() - slope * x.mean()), False
            out[i] = (lap, nxt, round(model[0] * nxt + model[1], 6))
    return out


SCHEMA = "PilotNumber int, Lap int, Seconds double, `@timestamp` timestamp, id long"


@pytest.mark.parametrize("n, cadence, block_rows", [(10, 2, 1 << 20), (5, 5, 7), (3, 2, 4)])
def test_arrival_order_equals_a_loop(spark, n, cadence, block_rows):
    rows = late_laps()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = regress.rolling_predict(
        df.withColumn("Lap", F.col("Lap")), n=n, cadence=cadence, tiebreak=("id",), order="arrival",
        block_rows=block_rows, max_key_rows=None if block_rows < 100 else regress.SKEW_KEY_ROWS,
    )
    want = sorted((r[0], *by_loop(rows, n, cadence)[r[4]]) for r in rows)
    assert sorted((r.PilotN, r.Lap, r.NextLap, round(r.prediction, 6)) for r in got.collect()) == want


def test_lap_order_and_arrival_order_differ_only_on_late_laps(spark):
    rows = [(1, lap, 80.0 + lap % 4, T0 + timedelta(seconds=lap), lap) for lap in range(1, 31)]
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda d: sorted((r.Lap, r.NextLap, round(r.prediction, 9)) for r in d.collect())
    assert key(regress.rolling_predict(df)) == key(regress.rolling_predict(df, order="arrival"))
    late = df.withColumn("@timestamp", F.when(F.col("Lap") == 5, F.lit(T0 + timedelta(hours=1))).otherwise(F.col("@timestamp")))
    late_rows = {r.Lap: r for r in regress.rolling_predict(late, order="arrival").collect()}
    assert late_rows[5].NextLap == 31 and late_rows[6].NextLap == 7


def test_odd_rows(spark):
    rows = [(1, 3, 80.0, None, 0), (1, None, 80.0, T0, 1), (1, 2, None, T0, 2), (None, 1, 80.0, T0, 3), (1, 1, 81.0, T0, 4)]
    got = [(r.Lap, r.NextLap) for r in regress.rolling_predict(spark.createDataFrame(rows, SCHEMA), order="arrival").collect()]
    assert sorted(got) == [(1, 4), (3, 4)]  # the row without a time comes first
    assert regress.rolling_predict(spark.createDataFrame([], SCHEMA), order="arrival").count() == 0


def test_chain_plan_has_one_shuffle(spark):
    df = spark.createDataFrame(late_laps(), SCHEMA).withColumn("rn", F.col("id"))
    out = arrival.top_so_far(df, ["PilotNumber"], "rn", F.struct("Lap", "id"), 10, "top", longest=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_state_arrays_equal_the_highest_so_far():
    rng = np.random.default_rng(1)
    order = rng.permutation(200)
    tops = predictor.top_so_far(order, 6)
    for i in range(200):
        want = sorted(order[: i + 1], reverse=True)[:6]
        assert [t for t in tops[:, i] if t >= 0] == want
