"""Per-driver rolling ridge fit and next-lap prediction.

A8 — one feature (Lap), label Seconds, L2 penalty ``reg`` — has a closed form
equal to Spark ML's ``LinearRegression`` defaults (standardised features and
label)::

    slope     = covar_pop(x, y) / var_pop(x) / (1 + reg / stddev_pop(y))
    intercept = avg(y) - slope * avg(x)
    (slope = 0 when var_pop(x) = 0 or stddev_pop(y) = 0)

so every driver's fit over its last ``n`` laps is a set of window aggregates:
one shuffle for all drivers instead of one ML job per lap.  Windows run over
(driver, row block) (see ``pitwall.plans.sequence``) so a driver with a third
of all laps is still spread over many tasks.

Refit cadence (W3): at each lap the model is refit when
``next_lap % cadence == 0``, when ``next_lap < 6`` or for the driver's first
lap; otherwise the last fitted model is reused.  Current parameters are
(n, cadence) = (10, 2); the older variant used (5, 5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.plans.sequence import (
    DEFAULT_BLOCK_ROWS,
    HALO,
    SKEW_KEY_ROWS,
    block_window,
    carry_forward,
    longest_sequence,
    number_rows_sized,
    with_blocks,
)
from pitwall.schemas import TS

# Fixed values of the prediction job.
CURRENT = {"n": 10, "cadence": 2, "reg": 0.01}
OLDER = {"n": 5, "cadence": 5, "reg": 0.01}
EARLY_REFIT_BELOW = 6  # refit while next lap < 6


def _keys(key) -> list[str]:
    """A driver key column, or several (e.g. session, driver) -- driver last."""
    return [key] if isinstance(key, str) else list(key)


def ridge_terms(cxy, vx, sy, mx, my, reg: float):
    """A8 closed form from window/group statistics -> (slope, intercept)."""
    slope = F.when((vx > 0) & (sy > 0), cxy / vx / (1 + F.lit(reg) / sy)).otherwise(F.lit(0.0))
    return slope, my - slope * mx


def driver_fit(buffer: DataFrame, key: str | list[str] = "PilotNumber", lap: str = "Lap",
               y: str = "Seconds", reg: float = CURRENT["reg"]) -> DataFrame:
    """A8 over whatever rows each driver has in ``buffer`` (e.g. the top-10
    buffer): one grouped aggregate, partial-aggregated before the shuffle."""
    keys = _keys(key)
    x = F.col(lap).cast("double")
    g = buffer.groupBy(*keys).agg(
        F.covar_pop(x, F.col(y)).alias("_cxy"),
        F.var_pop(x).alias("_vx"),
        F.stddev_pop(F.col(y)).alias("_sy"),
        F.avg(x).alias("_mx"),
        F.avg(F.col(y)).alias("_my"),
        F.max(lap).alias("_maxlap"),
        F.count(F.lit(1)).alias("n_laps"),
    )
    slope, icpt = ridge_terms(F.col("_cxy"), F.col("_vx"), F.col("_sy"), F.col("_mx"), F.col("_my"), reg)
    return g.select(
        *keys,
        slope.alias("slope"),
        icpt.alias("intercept"),
        (F.col("_maxlap") + 1).alias("NextLap"),
        "n_laps",
    )


def score(points: DataFrame, models: DataFrame, key: str | list[str] = "PilotNumber") -> DataFrame:
    """J3 + M4: join each (driver, NextLap) to the driver's model and predict
    (one row per driver on both sides, so the join has no hot key)."""
    keys = _keys(key)
    m = models.select(*keys, "slope", "intercept")
    return points.join(m, keys, "inner").withColumn(
        "prediction", F.col("slope") * F.col("NextLap") + F.col("intercept")
    )


def next_lap(laps: DataFrame, key: str | list[str] = "PilotNumber", lap: str = "Lap") -> DataFrame:
    """A1: next lap per driver = max(Lap) + 1."""
    return laps.groupBy(*_keys(key)).agg((F.max(lap) + 1).alias("NextLap"))


def rolling_predict(
    laps: DataFrame,
    *,
    key: str | list[str] = "PilotNumber",
    lap: str = "Lap",
    y: str = "Seconds",
    ts: str = TS,
    n: int = CURRENT["n"],
    cadence: int = CURRENT["cadence"],
    reg: float = CURRENT["reg"],
    seq: str | None = None,
    tiebreak: tuple[str, ...] = (),
    block_rows: int = DEFAULT_BLOCK_ROWS,
    max_key_rows: int | None = SKEW_KEY_ROWS,
    longest: int | None = None,
    order: str = "lap",
) -> DataFrame:
    """W1 + A8 + W3 + M4: one prediction per lap row, laps taken in Lap order,
    or with ``order="arrival"`` as they arrive (ST6, see
    ``pitwall.operators.arrival``; ``seq`` and ``longest`` are not used then).

    ``seq`` names a column that already holds a dense 1..k number per driver
    in Lap order (e.g. a Lap made by ``number_rows``); otherwise one is made.
    ``longest`` (laps of the biggest driver) saves a pass when already known.
    ``key`` may list several columns (e.g. session, driver; driver last).
    Returns ``[session keys], PilotN, Lap, NextLap, prediction, slope,
    intercept, @timestamp``.
    """
    if order == "arrival":
        from pitwall.operators.arrival import rolling_predict_arrival

        return rolling_predict_arrival(
            laps, key=key, lap=lap, y=y, ts=ts, n=n, cadence=cadence, reg=reg, tiebreak=tiebreak,
            block_rows=block_rows, max_key_rows=max_key_rows,
        )
    keys = _keys(key)
    base = laps
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    base = base.where(F.col(lap).isNotNull() & F.col(y).isNotNull())
    if seq is None:
        order = [lap] + ([ts] if ts in base.columns else []) + list(tiebreak)
        numbered, longest = number_rows_sized(base, keys, order, "_rn", max_key_rows=max_key_rows)
    else:
        numbered = base.withColumn("_rn", F.col(seq))
        if longest is None:
            longest = longest_sequence(numbered, "_rn")
    # split path only: size the (driver, block) shuffle from the row count
    total = numbered.count() if longest > block_rows else None
    blocked = with_blocks(numbered, keys, "_rn", block_rows, back=n - 1, longest=longest, total_rows=total)
    frame = block_window(keys, "_rn").rowsBetween(-(n - 1), 0)
    x = F.col(lap).cast("double")
    stats = blocked.select(
        *keys,
        lap,
        "_rn",
        "_blk",
        HALO,
        *([ts] if ts in blocked.columns else []),
        F.covar_pop(x, F.col(y)).over(frame).alias("_cxy"),
        F.var_pop(x).over(frame).alias("_vx"),
        F.stddev_pop(F.col(y)).over(frame).alias("_sy"),
        F.avg(x).over(frame).alias("_mx"),
        F.avg(F.col(y)).over(frame).alias("_my"),
        F.max(lap).over(frame).alias("_maxlap"),
    ).where(~F.col(HALO))
    slope, icpt = ridge_terms(F.col("_cxy"), F.col("_vx"), F.col("_sy"), F.col("_mx"), F.col("_my"), reg)
    nxt = F.col("_maxlap") + 1
    refit = (F.pmod(nxt, F.lit(cadence)) == 0) | (nxt < EARLY_REFIT_BELOW) | (F.col("_rn") == 1)
    fitted = stats.withColumn("NextLap", nxt.cast("int")).withColumn(
        "_model", F.when(refit, F.struct(slope.alias("s"), icpt.alias("i")))
    )
    carried = carry_forward(fitted, keys, "_rn", "_model", "_use", single_block=longest <= block_rows)
    return carried.select(
        *keys[:-1],
        F.col(keys[-1]).alias("PilotN"),
        F.col(lap).alias("Lap"),
        "NextLap",
        (F.col("_use.s") * F.col("NextLap") + F.col("_use.i")).alias("prediction"),
        F.col("_use.s").alias("slope"),
        F.col("_use.i").alias("intercept"),
        *([F.col(ts)] if ts in carried.columns else []),
    )


def fit_ml(group: DataFrame, lap: str = "Lap", y: str = "Seconds", reg: float = CURRENT["reg"],
           max_iter: int = 20):
    """M1-M3: Spark ML pipeline (VectorAssembler skip-invalid + LinearRegression)
    for one group of laps; kept as the cross-check of the closed form."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    va = VectorAssembler(inputCols=[lap], outputCol="features", handleInvalid="skip")
    lr = LinearRegression(featuresCol="features", labelCol=y, regParam=reg, maxIter=max_iter)
    return Pipeline(stages=[va, lr]).fit(group)
