"""Feed envelope parsing, fan-out and routing.

A raw line is parsed once into a VARIANT (``try_parse_json``); topic,
payload, time and the per-driver ``Lines`` are read from that binary form
with ``try_variant_get`` -- no level of the message is serialised and parsed
again.  ``Lines`` is exploded as ``map<driver, variant>`` (one row per driver
line) and the known timing fields are read from each line; the whole line is
kept as ``line_json`` text so unknown fields survive (keys come out sorted).
Malformed text gives null, never a failed job.  Duplicate keys in one object
make the line unparseable unless ``spark.sql.variant.allowDuplicateKeys`` is
true, in which case the last occurrence wins, as in the original replayer.

Routing follows the feed replayer:
  * ``WeatherData`` topic                     -> weather (whole payload)
  * payload text contains ``GapToLeader``     -> every line of the message to gaps
    (``route_scope="line"`` routes per line instead)
  * otherwise a line containing ``LastLapTime`` -> lap
  * recap (``R``) lines                       -> lap, lap text left unconverted
Everything else is dropped (route ``none``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.scalars import contains, lap_text_to_seconds, text_to_double, text_to_int
from pitwall.plans.joins import ROSTER_MAX, roster_semi_join
from pitwall.operators.laps import timed_lap
from pitwall.schemas import TS, WEATHER_FIELDS, WEATHER_TEXT

# Fixed values of the feed format.
WEATHER_TOPIC = "WeatherData"
GAP_MARK = "GapToLeader"
LAP_MARK = "LastLapTime"
BEST_LAP_MARK = "BestLapTime"
ROSTER_RENUMBER_FROM = "33"  # roster entry renumbered ...
ROSTER_RENUMBER_TO = 1  # ... to this car number
# JSON paths of the envelope
FEED_ARGS = "$.M[0].A"
RECAP_LINES = "$.R.TimingData.Lines"
FEED_LINES = "$.M[0].A[1].Lines"

DOC = "_doc"
GAP_TEXT = "_gap_text"  # raw line mentions GapToLeader (cheap pre-check)
LINES_TYPE = "map<string,variant>"
#: Columns that rows of the collections keep from the message, where it has them.
CARRIED = ("session", "event_id")


def _get(col, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(F.col(col) if isinstance(col, str) else col, path, typ)


def _present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def classify(raw: DataFrame, col: str = "value") -> DataFrame:
    """P1-P3 + F8: parse each line once and tag its kind.

    kind: ``text`` (no '{', P1), ``recap`` (top-level R), ``feed`` (has
    M[0].A), ``malformed`` (not JSON, so that loss can be counted), ``empty``
    (heartbeat ``{}``, empty ``M`` or anything else).
    Adds ``topic``, ``payload`` (text, computed only if used), ``msg_time``
    and the parsed document ``_doc``.
    """
    v = F.col(col)
    parsed = raw.withColumn(DOC, F.when(contains(v, "{"), F.try_parse_json(v)))
    kind = (
        F.when(~contains(v, "{"), F.lit("text"))
        .when(_present(_get(DOC, "$.R")), F.lit("recap"))
        .when(_present(_get(DOC, FEED_ARGS)), F.lit("feed"))
        .when(F.col(DOC).isNull(), F.lit("malformed"))
        .otherwise(F.lit("empty"))
    )
    return parsed.select(
        "*",
        kind.alias("kind"),
        _get(DOC, FEED_ARGS + "[0]", "string").alias("topic"),
        F.to_json(_get(DOC, FEED_ARGS + "[1]")).alias("payload"),
        _get(DOC, FEED_ARGS + "[2]", "string").alias("msg_time"),
        contains(v, GAP_MARK).alias(GAP_TEXT),
    )


def first_driver(doc: str = DOC) -> Column:
    """Driver key of the first line of a feed or recap document."""
    return F.coalesce(
        F.get(F.map_keys(_get(doc, RECAP_LINES, LINES_TYPE)), 0),
        F.get(F.map_keys(_get(doc, FEED_LINES, LINES_TYPE)), 0),
    )


def _line_fields(line: Column) -> Column:
    """The timing fields the engine reads (E4), as text."""

    def s(path):
        return F.try_variant_get(line, path, "string")

    return F.struct(
        s("$.NumberOfLaps").alias("NumberOfLaps"),
        F.struct(s("$.LastLapTime.Value").alias("Value")).alias("LastLapTime"),
        s("$.GapToLeader").alias("GapToLeader"),
        F.struct(s("$.IntervalToPositionAhead.Value").alias("Value")).alias("IntervalToPositionAhead"),
        F.struct(s("$.BestLapTime.Value").alias("Value")).alias("BestLapTime"),
    )


def _weather_fields(payload: Column) -> Column:
    """The weather fields (E10) as text, from the parsed payload."""
    return F.struct(*[F.try_variant_get(payload, f"$.{f}", "string").alias(f) for f in [*WEATHER_FIELDS, "WindDirection"]])


def fan_out(messages: DataFrame, route_scope: str = "message", gate: str | None = None) -> DataFrame:
    """One row per (message, driver line) with its ``route``.

    ``messages`` is the output of :func:`classify`.  Weather messages keep one
    row with ``driver`` null.  ``gate="best_lap"`` keeps feed messages only if
    their text contains BestLapTime (P7, cloud variant).
    """
    if route_scope not in ("message", "line"):
        raise ValueError("route_scope is 'message' or 'line'")
    # Only feed and recap messages have lines; other kinds explode to nothing,
    # so no filter is needed (a filter on ``kind`` would be pushed below the
    # parse and repeat it).
    # The gate works the same way: messages it stops have no lines.
    m = messages
    if gate not in (None, "best_lap"):
        raise ValueError("gate is None or 'best_lap'")
    passes = contains(F.col("value"), BEST_LAP_MARK) if gate else F.lit(True)
    is_weather = (F.col("kind") == "feed") & (F.col("topic") == WEATHER_TOPIC)
    lines_map = F.when(F.col("kind") == "recap", _get(DOC, RECAP_LINES, LINES_TYPE)).otherwise(
        F.when(~is_weather & passes, _get(DOC, FEED_LINES, LINES_TYPE))
    )
    # Weather keeps a single placeholder entry so explode emits one row.
    entries = F.when(is_weather & passes, F.map_from_arrays(F.array(F.lit("")), F.array(_get(DOC, FEED_ARGS + "[1]"))))
    # message scope: the original searches the text of the whole M[0] payload;
    # the payload is only serialised when the raw line mentions the mark at all
    msg_gap = (
        (F.col("kind") == "feed") & F.col(GAP_TEXT) & contains(F.col("payload"), GAP_MARK)
        if route_scope == "message"
        else F.lit(False)
    )
    # ``payload`` is not carried past this projection, so its text is built
    # only where the short-circuiting gap test needs it.
    flagged = m.select(
        *[c for c in m.columns if c != "payload"],
        is_weather.alias("_weather"),
        msg_gap.alias("_msg_gap"),
    )
    exploded = flagged.select(
        "*", F.explode(F.coalesce(entries, lines_map)).alias("_key", "_line")
    ).withColumn("line_json", F.to_json("_line"))
    line_gap = contains(F.col("line_json"), GAP_MARK)
    gap = F.col("_msg_gap") if route_scope == "message" else line_gap
    route = (
        F.when(F.col("_weather"), F.lit("weather"))
        .when(F.col("kind") == "recap", F.when(contains(F.col("line_json"), LAP_MARK), F.lit("lap")).otherwise(F.lit("none")))
        .when(gap, F.lit("gap"))
        .when(contains(F.col("line_json"), LAP_MARK), F.lit("lap"))
        .otherwise(F.lit("none"))
    )
    derived = {DOC, GAP_TEXT, "payload", "driver", "PilotNumber", "line_json", "line", "weather", "route"}
    driver = F.when(~F.col("_weather"), F.col("_key"))
    return exploded.select(
        *[c for c in messages.columns if c not in derived],
        driver.alias("driver"),
        driver.try_cast("int").alias("PilotNumber"),
        "line_json",
        F.when(~F.col("_weather"), _line_fields(F.col("_line"))).alias("line"),
        F.when(F.col("_weather"), _weather_fields(F.col("_line"))).alias("weather"),
        route.alias("route"),
    )


def normalise(raw: DataFrame, col: str = "value", roster: DataFrame | None = None,
              route_scope: str = "message", gate: str | None = None) -> DataFrame:
    """classify + fan_out + optional roster semi-join (J1, weather is kept)."""
    lines = fan_out(classify(raw, col), route_scope=route_scope, gate=gate)
    if roster is None:
        return lines
    return roster_semi_join(lines, roster, keep=F.col("route") == "weather").select(*lines.columns)


def msg_timestamp(col: str = "msg_time") -> F.Column:
    return F.try_to_timestamp(F.col(col))


def lap_rows(lines: DataFrame, convert_recap: bool = False) -> DataFrame:
    """P9 + F1 + P13 + P14: lap-route lines -> typed laps.

    Recap lap text is not converted by default, so its typed cast is null and
    the row is dropped, like the replayer.
    """
    lap = lines.where(F.col("route") == "lap")
    text = F.col("line.LastLapTime.Value")
    convert = F.col("kind") == "feed"
    if convert_recap:
        convert = F.lit(True)
    seconds = F.when(convert, lap_text_to_seconds(text)).otherwise(text.try_cast("double"))
    return lap.select(
        "PilotNumber",
        F.col("line.NumberOfLaps").try_cast("int").alias("Lap"),
        seconds.alias("Seconds"),
        msg_timestamp().alias(TS),
        *[c for c in CARRIED if c in lap.columns],
    ).where(timed_lap())


def gap_rows(lines: DataFrame) -> DataFrame:
    """S13 + F2 + F3 for gap-route lines -> gap documents."""
    g = lines.where(F.col("route") == "gap")
    return g.select(
        F.struct(
            text_to_int(F.col("PilotNumber").cast("string")).alias("PilotNumber"),
            text_to_double(F.col("line.GapToLeader")).alias("GapToLeader"),
            F.struct(text_to_double(F.col("line.IntervalToPositionAhead.Value")).alias("Value")).alias(
                "IntervalToPositionAhead"
            ),
        ).alias("Gaps"),
        msg_timestamp().alias(TS),
        *[c for c in CARRIED if c in g.columns],
    )


def weather_rows(lines: DataFrame) -> DataFrame:
    """S13 + F2 + F3 for weather messages -> weather documents."""
    w = lines.where(F.col("route") == "weather")
    if "weather" not in w.columns:
        w = w.withColumn("weather", F.from_json(F.col("line_json"), WEATHER_TEXT))
    return w.select(
        F.struct(
            text_to_double(F.col("weather.AirTemp")).alias("AirTemp"),
            text_to_double(F.col("weather.Humidity")).alias("Humidity"),
            text_to_double(F.col("weather.Pressure")).alias("Pressure"),
            text_to_double(F.col("weather.Rainfall")).alias("Rainfall"),
            text_to_double(F.col("weather.TrackTemp")).alias("TrackTemp"),
            text_to_int(F.col("weather.WindDirection")).alias("WindDirection"),
            text_to_double(F.col("weather.WindSpeed")).alias("WindSpeed"),
        ).alias("Weather"),
        msg_timestamp().alias(TS),
        *[c for c in CARRIED if c in w.columns],
    )


def roster_numbers(doc: DataFrame, col: str = "value", limit: int | None = ROSTER_MAX) -> DataFrame:
    """S6 + P16 + T4: roster document text -> ``pilot INT`` for the first
    ``limit`` entries by position (20, as the original takes; None: all of
    them), "33" renumbered to 1, other text cast to int."""
    from pitwall.schemas import ROSTER_DOC

    parsed = doc.select(F.from_json(F.col(col), ROSTER_DOC).alias("d"))
    entries = parsed.select(F.posexplode("d.MRData.DriverTable.Drivers").alias("pos", "drv"))
    num = F.col("drv.permanentNumber")
    return (entries if limit is None else entries.where(F.col("pos") < limit)).select(
        "pos",
        F.when(num == ROSTER_RENUMBER_FROM, F.lit(ROSTER_RENUMBER_TO)).otherwise(num.try_cast("int")).alias("pilot"),
    )
