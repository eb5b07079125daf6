"""Keyed-state next-lap predictor for Structured Streaming (ST3-ST6, ST4, S7).

Drivers are dealt by hash to a fixed number of shards, the state keys: a call
into the state store costs milliseconds and not microseconds, so a shard's state
is read once and written once in a micro-batch, for all its drivers.  One
``StatefulProcessor`` keeps for each driver of its shard, in one ValueState,

  * the buffer -- at most ``n`` (Lap, Seconds, time) rows, the highest
    (Lap, time) seen so far, as in the batch buffers (ST3, bounded: a driver's
    state never grows with the stream);
  * the model  -- (slope, intercept) of the last refit (ST4).

For every arriving lap (in event-time order inside a micro-batch): the row
joins the buffer, the buffer keeps its top ``n`` laps, ``next = max(Lap) + 1``
and the model is refit when ``next % cadence == 0``, ``next < 6`` or there is
no model yet; one prediction row is emitted (ST5).  A late lap may enter the
buffer but never lowers ``next`` (ST6).  Each arriving row is appended once.

A shard's rows of a micro-batch are handled as arrays, driver after driver: one
sort ranks them, ``n`` running maxima give every row its buffer, the fit is the closed form of
``pitwall.operators.regress`` over all buffers at once, and the last refit is
filled forward; Spark partitions the keys and keeps the state in the
state store (RocksDB), so nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
    TimestampType,
)

TS = "@timestamp"
EVENT_TIME = "ts"  # '@timestamp' does not survive the trip to the Python worker
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"

#: State keys of a stream, fixed when it first starts (as state partitions are):
#: at least the cores of a large cluster, a shard's state is some 300 bytes a driver.
SHARDS = 1024
SHARD = "_shard"
#: State of a shard: the model and the number of buffered laps of each driver, then
#: the laps of all drivers, a driver's highest first.
MODEL_FIELDS = (("slope", DoubleType()), ("intercept", DoubleType()), ("laps", IntegerType()))
BUFFER_FIELDS = (("Lap", IntegerType()), ("Seconds", DoubleType()), ("micros", LongType()))
OUTPUT_SCHEMA = StructType(
    [
        StructField("PilotN", IntegerType()),
        StructField("Lap", IntegerType()),
        StructField("NextLap", IntegerType()),
        StructField("prediction", DoubleType()),
        StructField("slope", DoubleType()),
        StructField("intercept", DoubleType()),
        StructField(EVENT_TIME, TimestampType()),
    ]
)


def top_so_far(arriving: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` highest ranks up to each arrival, one row for each place (-1:
    none yet).  A chain of running maxima: what an arrival displaces from one
    place goes on to the next."""
    places = []
    for _ in range(n):
        top = np.maximum.accumulate(arriving)
        places.append(top)
        arriving = np.minimum(np.concatenate(([-1], top[:-1])), arriving)
    return np.stack(places)


def fits(laps: np.ndarray, secs: np.ndarray, tops: np.ndarray, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """A8 on the buffer of every arrival (population statistics)."""
    there = tops >= 0
    k = there.sum(axis=0)
    x, y = np.where(there, laps[tops], 0).astype(float), np.where(there, secs[tops], 0.0)
    mx, my = x.sum(axis=0) / k, y.sum(axis=0) / k
    x, y = np.where(there, x - mx, 0.0), np.where(there, y - my, 0.0)
    vx, sy = (x * x).sum(axis=0) / k, np.sqrt((y * y).sum(axis=0) / k)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where((vx > 0) & (sy > 0), (x * y).sum(axis=0) / k / vx / (1 + reg / sy), 0.0)
    return slope, my - slope * mx


def _plain(values) -> list:
    """Python values for the state, None where there is none."""
    return [None if pd.isna(v) else v for v in pd.Series(values).astype(object)]


class RollingPredictor(StatefulProcessor):
    def __init__(self, n: int = 10, cadence: int = 2, reg: float = 0.01, early_below: int = 6,
                 keys: tuple[StructField, ...] = (StructField("PilotNumber", IntegerType()),)):
        self.n, self.cadence, self.reg, self.early_below = n, cadence, reg, early_below
        self.keys = [k.name for k in keys]  # session keys..., driver
        fields = [*[(f"key{i}", k.dataType) for i, k in enumerate(keys)], *MODEL_FIELDS, *BUFFER_FIELDS]
        self.schema = StructType([StructField(name, ArrayType(kind)) for name, kind in fields])
        self.columns = [*self.keys[:-1], *[f.name for f in OUTPUT_SCHEMA.fields]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.drivers = handle.getValueState("drivers", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        state = self.drivers.get() or [[] for _ in self.schema]
        m = len(self.keys)
        names, (slope0, intercept0, sizes) = state[:m], (np.array(v, float) for v in state[m : m + 3])
        sizes, known = sizes.astype(np.int64), len(sizes)
        held = [np.array(v, t)[::-1] for v, t in zip(state[m + 3 :], (np.int64, float, np.int64))]
        # drivers by number: those of the state first, in its order
        who = pd.DataFrame({k: pd.Series(list(v) + batch[k].tolist(), dtype=object) for k, v in zip(self.keys, names)})
        number = who.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        drivers = who[~pd.Series(number).duplicated()]
        count = len(drivers)
        # arrivals by driver: laps held, then the new ones by time; held ones oldest
        # first, so that of equal (Lap, time) the newer row ranks higher
        when = batch[EVENT_TIME].astype("datetime64[ns]").to_numpy().view(np.int64) // 1000
        new_laps = batch["Lap"].to_numpy(np.int64)
        come = np.lexsort((new_laps, when))
        driver = np.concatenate((np.repeat(np.arange(known), sizes)[::-1], number[known:][come]))
        order = np.argsort(driver, kind="stable")
        driver, new = driver[order], (order >= len(held[0]))
        laps = np.concatenate((held[0], new_laps[come]))[order]
        secs = np.concatenate((held[1], batch["Seconds"].to_numpy(float)[come]))[order]
        at = np.concatenate((held[2], when[come]))[order]
        ranked = np.lexsort((np.arange(len(laps)), at, laps, driver))
        arriving = np.empty(len(ranked), np.int64)
        arriving[ranked] = np.arange(len(ranked))
        # ranks rise from driver to driver: what lies below a driver's own is another's
        first = np.searchsorted(driver, driver)
        tops = top_so_far(arriving, self.n)
        tops = np.where(tops >= first, tops, -1)[:, new]
        by_rank = [v[ranked] for v in (laps, secs, at)]
        slopes, intercepts = fits(by_rank[0], by_rank[1], tops, self.reg)
        nxt = by_rank[0][tops[0]] + 1
        driver = driver[new]
        refit = (nxt % self.cadence == 0) | (nxt < self.early_below)
        start = np.searchsorted(driver, driver)
        refit |= (start == np.arange(len(driver))) & (driver >= known)  # no model yet
        used = np.maximum.accumulate(np.where(refit, np.arange(len(nxt)), -1))
        old = used < start
        before = np.where(old, driver, 0)
        slope = np.where(old, np.append(slope0, 0.0)[np.minimum(before, known)], slopes[used])
        intercept = np.where(old, np.append(intercept0, 0.0)[np.minimum(before, known)], intercepts[used])
        # the state: drivers that had no lap keep theirs
        last = np.flatnonzero(np.append(driver[1:] != driver[:-1], True))
        met = driver[last]
        model = np.zeros((2, count))
        model[:, :known] = slope0, intercept0
        model[:, met] = slope[last], intercept[last]
        kept = tops[:, last].T  # highest first
        there = kept >= 0
        stay = np.repeat(~np.isin(np.arange(known), met), sizes)
        owner = np.concatenate((np.repeat(np.arange(known), sizes)[stay], np.repeat(met, there.sum(axis=1))))
        place = np.argsort(owner, kind="stable")
        buffers = [np.concatenate((h[::-1][stay], v[kept[there]]))[place].tolist() for h, v in zip(held, by_rank)]
        self.drivers.update((
            *[_plain(drivers[k]) for k in self.keys], *model.tolist(), np.bincount(owner, minlength=count).tolist(), *buffers,
        ))
        source = come[order[new] - len(held[0])]
        out = {k: batch[k].to_numpy()[source] for k in self.keys[:-1]}
        out |= {"PilotN": batch[self.keys[-1]].to_numpy()[source], "Lap": new_laps[source], "NextLap": nxt, "prediction": slope * nxt + intercept, "slope": slope, "intercept": intercept, EVENT_TIME: batch[EVENT_TIME].to_numpy()[source]}
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def predict_stream(laps, key: str | list[str] = "PilotNumber", n: int = 10, cadence: int = 2, reg: float = 0.01, shards: int = SHARDS):
    """ST1-ST6: streaming laps (PilotNumber, Lap, Seconds, @timestamp) ->
    one prediction row per lap.  ``key`` may list (session, driver) columns,
    driver last; their hash modulo ``shards`` is
    the key of the state.  The session must use the RocksDB state store (see
    :func:`use_rocksdb`)."""
    from pyspark import cloudpickle

    import pitwall.streaming.predictor as me
    from pitwall.operators.laps import timed_lap

    # Workers need the processor class but not the package on their path.
    cloudpickle.register_pickle_by_value(me)
    keys = [key] if isinstance(key, str) else list(key)
    cols = laps.select(*keys, "Lap", "Seconds", laps[TS].alias(EVENT_TIME)).where(timed_lap())
    fields = [cols.schema[k] for k in keys]
    schema = StructType([*fields[:-1], *OUTPUT_SCHEMA.fields])
    shard = F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int")
    out = cols.withColumn(SHARD, shard).groupBy(SHARD).transformWithStateInPandas(
        statefulProcessor=RollingPredictor(n=n, cadence=cadence, reg=reg, keys=tuple(fields)),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )
    return out.withColumnRenamed(EVENT_TIME, TS)


class use_rocksdb:
    """Context manager: RocksDB state store for queries started inside it."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get(STATE_PROVIDER_CONF, None)
        self.spark.conf.set(STATE_PROVIDER_CONF, ROCKSDB)
        return self

    def __exit__(self, *exc):
        if self.old is None:
            self.spark.conf.unset(STATE_PROVIDER_CONF)
        else:
            self.spark.conf.set(STATE_PROVIDER_CONF, self.old)
        return False
