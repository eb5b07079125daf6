"""Lap messages on the bus and per-driver lap buffers.

Lap message (bus value)::

    {"TimingData": {...line fields..., "PilotNumber": 16}, "@timestamp": "..."}

``lap_messages`` builds it (F7, to_json), ``parse_lap_messages`` reads it back
the way the prediction job does: bytes -> text, four JSON fields, ``try_cast``
(ANSI casts would fail on "1:18.234"), then the not-null filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.scalars import iso_utc
from pitwall.schemas import TS

# Fixed values of the bus.
TOPIC = "LiveTimingData"
RECORD_KEY = "info"
CURRENT_BUFFER = 10
OLDER_BUFFER = 5
# The fields read from a lap message, as text.
LAP_MESSAGE = (
    "TimingData STRUCT<PilotNumber: STRING, NumberOfLaps: STRING, LastLapTime: STRUCT<Value: STRING>>, "
    "`@timestamp` STRING"
)


def timed_lap() -> Column:
    """A lap with its number and its time."""
    return F.col("Lap").isNotNull() & F.col("Seconds").isNotNull()


def lap_messages(laps: DataFrame, seconds_col: str = "Seconds", ts: str = TS) -> DataFrame:
    """Typed laps -> ``value`` JSON text as the ingest writes it."""
    td = F.struct(
        F.col("Lap").alias("NumberOfLaps"),
        F.struct(F.col(seconds_col).alias("Value")).alias("LastLapTime"),
        F.col("PilotNumber").alias("PilotNumber"),
    )
    doc = F.struct(td.alias("TimingData"), iso_utc(ts).alias(TS))
    return laps.select("*", F.to_json(doc).alias("value"))


def keyed_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """Bus records with the constant key ``info``."""
    return messages.select(F.lit(RECORD_KEY).alias("key"), F.col(value).alias("value"))


def parse_lap_messages(records: DataFrame, value: str = "value") -> DataFrame:
    """P11 + P12 + P13 + P14: bus value (bytes or text) -> typed laps.  The
    not-null filter stays above the one-element ``inline``, so each record is
    parsed once."""
    doc = F.from_json(F.col(value).cast("string"), LAP_MESSAGE)
    rest = [c for c in records.columns if c != value]
    j = records.select(*rest, F.inline(F.array(F.struct(doc.alias("_doc")))))
    return j.select(
        F.col("_doc.TimingData.PilotNumber").try_cast("int").alias("PilotNumber"),
        F.col("_doc.TimingData.NumberOfLaps").try_cast("int").alias("Lap"),
        F.col("_doc.TimingData.LastLapTime.Value").try_cast("double").alias("Seconds"),
        F.try_to_timestamp(F.col(f"_doc.`{TS}`")).alias(TS),
        *rest,
    ).where(timed_lap())


def lap_buffer(laps: DataFrame, n: int = CURRENT_BUFFER, key: str | list[str] = "PilotNumber", lap: str = "Lap",
               ts: str = TS) -> DataFrame:
    """T1/T2 + U1: each driver's ``n`` highest laps (ties: later first).

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each task ships at most ``n`` rows per driver.
    """
    order = [F.col(lap).desc()] + ([F.col(ts).desc()] if ts in laps.columns else [])
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return laps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def pace_order(table: DataFrame, seconds: str = "Seconds", key: str = "PilotNumber") -> DataFrame:
    """Faster first."""
    return table.orderBy(F.asc_nulls_last(seconds), key)
