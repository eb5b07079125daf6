"""ST7: the table panels as continuously updated state.

A panel's buckets widen as its range grows, so bucketed state would have to be
rebuilt.  The state is kept one level finer instead, at unit buckets: for every
(driver, lap) or driver the last value and the moment it was set.  Both are
maxima, so states merge: ``update`` output needs no keyed overwrite but is
appended, batch by batch, and a reader that takes the latest moment of each
unit bucket gets the same result however often a batch was retried.  At read
the unit buckets are merged into the panel's buckets by the same rule.

State and table hold one row for each unit bucket (distinct drivers x laps);
Spark combines a hot driver's rows on each task before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import dashboard as D
from pitwall.schemas import TS


@dataclass(frozen=True)
class Panel:
    """Unit keys (name -> source column) and last values (name -> source)."""

    name: str
    keys: dict[str, str]
    values: dict[str, str]


RACE_PACE = Panel("panel_race_pace", {"pilot": "PilotNumber", "x": "Lap"}, {"seconds": "Seconds"})
PREDICTION = Panel("panel_prediction", {"pilot": "PilotN", "x": "NextLap"}, {"prediction": "prediction"})
GAPS = Panel("panel_gaps", {"pilot": "Gaps.PilotNumber"}, {"gap_to_previous": "Gaps.IntervalToPositionAhead.Value", "gap_to_leader": "Gaps.GapToLeader"})
WEATHER = Panel("panel_weather", {}, {f: f"Weather.{f}" for f in D.WEATHER_PANEL})


def _moment(value: str, tiebreak: Sequence[str]) -> Column:
    return F.when(F.col(value).isNotNull(), D.moment(TS, tiebreak))


def state(rows: DataFrame, panel: Panel, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The panel's unit buckets: keys, and for each value ``v`` also ``v_at``.
    A stream gives a stream (output mode ``update``)."""
    for source in panel.keys.values():
        rows = rows.where(F.col(source).isNotNull())
    keys = [F.col(source).alias(name) for name, source in panel.keys.items()]
    aggs = []
    for name, source in panel.values.items():
        at = _moment(source, tiebreak)
        aggs += [F.max_by(F.col(source), at).alias(name), F.max(at).alias(f"{name}_at")]
    return rows.groupBy(*keys).agg(*aggs)


def merged(states: DataFrame, panel: Panel, by: Sequence[Column] = ()) -> DataFrame:
    """Rows of state (of any batches) merged over ``by`` (the unit keys, or
    coarser buckets of them)."""
    aggs = []
    for name in panel.values:
        aggs += [F.max_by(name, f"{name}_at").alias(name), F.max(f"{name}_at").alias(f"{name}_at")]
    return states.groupBy(*(by or panel.keys)).agg(*aggs)


def table(states: DataFrame, panel: Panel) -> DataFrame:
    """D2 or D4 from unit buckets: last value of each bucket, collapsed by max."""
    (value,) = panel.values
    bars = D.AUTO_MAX_BARS if panel is RACE_PACE else D.LINE_MAX_BARS
    iv = D.histogram_intervals(states, {"x": D.SINGLE_BAR, "pilot": bars})
    ranged = states.where(D.in_range("x"))
    buckets = [D.bucket("pilot", iv["pilot"]).alias("pilot_bucket"), D.bucket("x", iv["x"]).alias("x_bucket")]
    return merged(ranged, panel, buckets).groupBy("pilot_bucket").agg(F.max(value).alias(value))


def bars(states: DataFrame, panel: Panel = GAPS) -> DataFrame:
    """D5 from unit buckets."""
    iv = D.histogram_interval(states, "pilot", D.LINE_MAX_BARS)
    return merged(states, panel, [D.bucket("pilot", iv).alias("pilot_bucket")]).select("pilot_bucket", *panel.values)


def latest(states: DataFrame, panel: Panel = WEATHER) -> DataFrame:
    """One row, also where nothing has come."""
    return states.agg(*[F.max_by(v, f"{v}_at").alias(v) for v in panel.values])


def read(spark: SparkSession, root: str, panel: Panel) -> DataFrame:
    """All updates written below ``root``; merge with ``table``, ``bars`` or
    ``latest``, or with ``merged`` down to one row for each unit bucket."""
    return spark.read.parquet(f"{root}/{panel.name}").drop("batch_id")
