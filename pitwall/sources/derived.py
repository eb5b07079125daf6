"""Feed data derived from the ``events`` table (the test mapping).

The reference ships no captures, so raw feed text is built from ``events`` by
string concatenation in Spark and then parsed by the engine, while the SQL
oracles compute the expected rows straight from ``events``:

  PilotNumber = user_id            Lap = row number per user by (ts, event_id)
  Seconds     = value              @timestamp = ts (UTC)
  click, view -> timing line with a lap time (click also carries BestLapTime)
  purchase    -> timing line with GapToLeader / IntervalToPositionAhead
  error       -> WeatherData message
  signup      -> timing line with neither field (dropped by routing)

Everything is a DataFrame transformation of ``events``, so the work grows with
the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.functions.scalars import seconds_to_lap_text, utc_instant
from pitwall.plans.sequence import number_rows_sized
from pitwall.schemas import TS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered_events(events: DataFrame) -> DataFrame:
    """events + ``Lap`` (row number per user by ts, event_id), skew-safe."""
    return numbered_events_sized(events)[0]


def numbered_events_sized(events: DataFrame) -> tuple[DataFrame, int]:
    """:func:`numbered_events` plus the event count of the biggest user."""
    e = events.select(
        "event_id",
        "ts",
        F.col("user_id").cast("int").alias("PilotNumber"),
        "event_type",
        "value",
        "props",
    )
    n, largest = number_rows_sized(e, ["PilotNumber"], ["ts", "event_id"], "Lap")
    return n.withColumn("Lap", F.col("Lap").cast("int")), largest


def laps_from_events(events: DataFrame, stride: int = 1, numbered: DataFrame | None = None) -> DataFrame:
    """Typed laps (E6) from every event: Lap = stride * row number."""
    n = numbered if numbered is not None else numbered_events(events)
    return n.select(
        "PilotNumber",
        (F.col("Lap") * stride).cast("int").alias("Lap"),
        F.col("value").alias("Seconds"),
        utc_instant("ts").alias(TS),
        "event_id",
    )


#: Arrivals in which one lap overtakes the others (see ``late_laps``).
LATE_GROUP = 6


def late_laps(numbered: DataFrame, group: int = LATE_GROUP) -> DataFrame:
    """Typed laps that arrive out of order: of every ``group`` arrivals of a
    driver the first carries the highest lap of the group, the others come one
    lap late each.  Arrival (``@timestamp``) stays as it is."""
    first = (F.col("Lap") - 1) % group == 0
    lap = F.when(first, F.col("Lap") + group - 1).otherwise(F.col("Lap") - 1)
    return laps_from_events(None, numbered=numbered.withColumn("Lap", lap))


def _k(props) -> F.Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def _line_json(numbered: DataFrame) -> F.Column:
    et = F.col("event_type")
    lap_text = seconds_to_lap_text(F.col("value"))
    k = _k(F.col("props"))
    lap_line = F.concat(
        F.lit('{"NumberOfLaps":'),
        F.col("Lap").cast("string"),
        F.lit(',"LastLapTime":{"Value":"'),
        lap_text,
        F.lit('"}'),
        F.when(et == "click", F.concat(F.lit(',"BestLapTime":{"Value":"'), lap_text, F.lit('"}'))).otherwise(
            F.lit("")
        ),
        F.lit("}"),
    )
    gap_line = F.concat(
        F.lit('{"GapToLeader":"+'),
        F.format_string("%.3f", F.col("value")),
        F.lit('","IntervalToPositionAhead":{"Value":"+'),
        F.format_string("%.1f", k / 10.0),
        F.lit('"}}'),
    )
    other_line = F.concat(F.lit('{"Position":"'), k.cast("string"), F.lit('"}'))
    return (
        F.when(et.isin("click", "view"), lap_line)
        .when(et == "purchase", gap_line)
        .otherwise(other_line)
    )


def _weather_payload() -> F.Column:
    v = F.col("value")
    k = _k(F.col("props"))
    return F.concat(
        F.lit('{"AirTemp":"'), F.format_string("%.2f", v),
        F.lit('","Humidity":"'), k.cast("string"),
        F.lit('","Pressure":"'), F.format_string("%.1f", 1000 + k / 10.0),
        F.lit('","Rainfall":"'), F.when(k >= 50, F.lit("1")).otherwise(F.lit("0")),
        F.lit('","TrackTemp":"'), F.format_string("%.2f", v + 10),
        F.lit('","WindDirection":"'), (k * 3).cast("string"),
        F.lit('","WindSpeed":"'), F.format_string("%.1f", k / 10.0),
        F.lit('"}'),
    )


def feed_messages(events: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """One raw feed envelope per event: ``event_id, ts, value`` (text)."""
    n = numbered if numbered is not None else numbered_events(events)
    iso = F.date_format(F.col("ts"), ISO_FORMAT)
    driver = F.col("PilotNumber").cast("string")
    timing = F.concat(F.lit('{"Lines":{"'), driver, F.lit('":'), _line_json(n), F.lit("}}"))
    is_weather = F.col("event_type") == "error"
    topic = F.when(is_weather, F.lit("WeatherData")).otherwise(F.lit("TimingData"))
    payload = F.when(is_weather, _weather_payload()).otherwise(timing)
    msg = F.concat(F.lit('{"M":[{"A":["'), topic, F.lit('",'), payload, F.lit(',"'), iso, F.lit('"]}]}'))
    return n.select("event_id", "ts", "PilotNumber", "event_type", msg.alias("value"))


def recap_messages(events: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """A snapshot (recap) envelope per signup event, lap text left as m:ss.fff."""
    n = numbered if numbered is not None else numbered_events(events)
    line = F.concat(
        F.lit('{"NumberOfLaps":'), F.col("Lap").cast("string"),
        F.lit(',"LastLapTime":{"Value":"'), seconds_to_lap_text(F.col("value")), F.lit('"}}'),
    )
    msg = F.concat(
        F.lit('{"R":{"TimingData":{"Lines":{"'), F.col("PilotNumber").cast("string"), F.lit('":'), line,
        F.lit("}}}}"),
    )
    return n.where(F.col("event_type") == "signup").select("event_id", "ts", "PilotNumber", msg.alias("value"))


def capture_lines(events: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """A raw capture with every kind of line: feed envelopes for all events,
    plus per event type one extra line -- recap (signup), empty feed message
    (purchase), heartbeat ``{}`` (error) and a non-JSON text line (view).
    Each line keeps its event's ``event_id``, ``PilotNumber`` and ``ts``."""
    n = numbered if numbered is not None else numbered_events(events)
    keep = ["event_id", "PilotNumber", "ts"]
    feed = feed_messages(events, n).select(*keep, F.lit(0).alias("part"), "value")
    recap = recap_messages(events, n).select(*keep, F.lit(1).alias("part"), "value")
    extra = n.where(F.col("event_type").isin("purchase", "error", "view")).select(
        *keep,
        F.lit(1).alias("part"),
        F.when(F.col("event_type") == "purchase", F.lit('{"M":[]}'))
        .when(F.col("event_type") == "error", F.lit("{}"))
        .otherwise(F.lit("keepalive")).alias("value"),
    )
    return feed.unionByName(recap).unionByName(extra)


def literal_payloads(events: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Host-language literal lines as the cloud replayer wrote them (single
    quotes, True/None, PilotNumber as text), one per click/view event."""
    n = numbered if numbered is not None else numbered_events(events)
    et = F.col("event_type")
    text = F.concat(
        F.lit("{'NumberOfLaps': "), F.col("Lap").cast("string"),
        F.lit(", 'LastLapTime': {'Value': '"), seconds_to_lap_text(F.col("value")),
        F.lit("', 'PersonalFastest': "), F.when(et == "click", F.lit("True")).otherwise(F.lit("False")),
        F.lit("}, 'Retired': None, 'PilotNumber': '"), F.col("PilotNumber").cast("string"), F.lit("'}"),
    )
    return n.where(et.isin("click", "view")).select("event_id", "ts", text.alias("value"))


def roster_document(events: DataFrame, entries: int = 21) -> DataFrame:
    """A one-row roster document (E12) listing the first ``entries`` drivers by
    first appearance.  The list is bounded: a top-k of a per-driver aggregate."""
    first = events.groupBy(F.col("user_id").cast("int").alias("pilot")).agg(F.min("ts").alias("first"))
    top = first.orderBy("first", "pilot").limit(entries)
    drivers = F.transform(
        F.array_sort(F.collect_list(F.struct("first", "pilot"))),
        lambda d: F.struct(d["pilot"].cast("string").alias("permanentNumber")),
    )
    doc = F.struct(F.struct(F.struct(drivers.alias("Drivers")).alias("DriverTable")).alias("MRData"))
    return top.agg(F.to_json(doc).alias("value"))
