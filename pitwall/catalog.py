"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given parquet tables (or data Spark derives from them)
and runs over the whole table.  Column names match the SQL oracles in
``pitwall.oracle``; doubles are rounded to 4 decimals and times are given as
epoch milliseconds (``ts_ms``) so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.config import scratch_path, state_partitions
from pitwall.functions import scalars as S
from pitwall.operators import dashboard as D
from pitwall.operators import envelope as E
from pitwall.operators import laps as L
from pitwall.operators import pacing as P
from pitwall.operators import regress
from pitwall.plans.lineage import materialize
from pitwall.schemas import TS
from pitwall.sources import capture as C
from pitwall.sources import derived as V
from pitwall.sources.collections import CollectionCatalog
from pitwall.streaming import panels as PN
from pitwall.streaming import predictor as SP
from pitwall.streaming import sinks as SK
from pitwall.streaming import store as ST

Query = Callable[[SparkSession, str], DataFrame]

# Pacing bound for the test mapping: its events are hours apart, so the
# replayer's 10 s bound is scaled to two hours.
FIXTURE_MAX_DELTA = 7200.0
# Documents per concatenated capture file written by concat_json_split.
DOCS_PER_FILE = 5000


def _r4(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def _ms(c: str = TS) -> F.Column:
    return S.instant_millis(F.col(c)).alias("ts_ms")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.load(spark, sf_dir, "events")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.numbered_events(_events(spark, sf_dir))


def _feed_lines(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Raw feed envelopes derived from events, parsed and routed."""
    msgs = V.feed_messages(None, _numbered(spark, sf_dir))
    return E.normalise(msgs, **kw)


def _feed_laps(spark: SparkSession, sf_dir: str, reused: bool = True) -> DataFrame:
    """Typed laps of the feed, written once where a size check, an interval
    aggregate and the final query all read them (``reused``)."""
    laps = E.lap_rows(_feed_lines(spark, sf_dir)).select("PilotNumber", "Lap", "Seconds", TS, "event_id")
    return materialize(laps) if reused else laps


# --- regression (W1 A8 W3 M4 T1 T2 A1 J3) ------------------------------------

def rolling_lap_prediction(spark: SparkSession, sf_dir: str, params: dict = regress.CURRENT) -> DataFrame:
    """Flagship: next-lap prediction at every lap of every driver."""
    numbered, longest = V.numbered_events_sized(_events(spark, sf_dir))
    laps = V.laps_from_events(None, numbered=numbered)
    pred = regress.rolling_predict(
        laps, n=params["n"], cadence=params["cadence"], reg=params["reg"], seq="Lap", longest=longest
    )
    return pred.select(F.col("PilotN").alias("PilotNumber"), "NextLap", _r4("prediction").alias("prediction"))


def rolling_lap_prediction_n5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_lap_prediction(spark, sf_dir, regress.OLDER)


def late_lap_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 in the batch predictor: laps that come late, taken as they arrive."""
    laps = V.late_laps(_numbered(spark, sf_dir))
    pred = regress.rolling_predict(laps, tiebreak=("event_id",), order="arrival")
    return pred.select(F.col("PilotN").alias("PilotNumber"), "Lap", "NextLap", _r4("prediction").alias("prediction"))


def _buffer(spark, sf_dir, n):
    laps = V.laps_from_events(None, numbered=_numbered(spark, sf_dir))
    return L.lap_buffer(laps, n)


def lap_buffer_top10(spark: SparkSession, sf_dir: str, n: int = L.CURRENT_BUFFER) -> DataFrame:
    b = _buffer(spark, sf_dir, n)
    return b.select("PilotNumber", "Lap", _r4("Seconds").alias("Seconds"), F.col("rank").cast("int").alias("buffer_pos"))


def lap_buffer_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lap_buffer_top10(spark, sf_dir, L.OLDER_BUFFER)


def next_lap_per_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = V.laps_from_events(None, numbered=_numbered(spark, sf_dir))
    return regress.next_lap(laps).select("PilotNumber", F.col("NextLap").cast("int").alias("NextLap"))


def driver_ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = regress.driver_fit(_buffer(spark, sf_dir, L.CURRENT_BUFFER))
    return fit.select(
        "PilotNumber",
        _r4("slope").alias("slope"),
        _r4("intercept").alias("intercept"),
        F.col("NextLap").cast("int").alias("NextLap"),
        "n_laps",
    )


def driver_score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = V.laps_from_events(None, numbered=_numbered(spark, sf_dir))
    models = regress.driver_fit(L.lap_buffer(laps, L.CURRENT_BUFFER)).drop("NextLap")
    scored = regress.score(regress.next_lap(laps), models)
    return scored.select("PilotNumber", F.col("NextLap").cast("int").alias("NextLap"), _r4("prediction").alias("prediction"))


# --- lap messages and scalars (P11-P14 F1-F5) --------------------------------

def parse_lap_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus lap messages as bytes: click -> numeric lap time, view -> lap text
    left unconverted (typed cast null, dropped), signup -> no lap count."""
    n = _numbered(spark, sf_dir).where(F.col("event_type").isin("click", "view", "signup"))
    et = F.col("event_type")
    value = F.when(et == "view", F.concat(F.lit('"'), S.seconds_to_lap_text(F.col("value")), F.lit('"'))).otherwise(
        F.format_string("%.2f", F.col("value"))
    )
    laps_part = F.when(et != "signup", F.concat(F.lit('"NumberOfLaps":'), F.col("Lap").cast("string"), F.lit(","))).otherwise(
        F.lit("")
    )
    text = F.concat(
        F.lit('{"TimingData":{'), laps_part, F.lit('"LastLapTime":{"Value":'), value,
        F.lit('},"PilotNumber":'), F.col("PilotNumber").cast("string"),
        F.lit('},"@timestamp":"'), F.date_format("ts", V.ISO_FORMAT), F.lit('"}'),
    )
    records = n.select(text.cast("binary").alias("value"))
    laps = L.parse_lap_messages(records)
    return laps.select("PilotNumber", "Lap", _r4("Seconds").alias("Seconds"), _ms())


def lap_text_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(
        "event_id",
        _r4(S.lap_text_to_seconds(S.seconds_to_lap_text(F.col("value")))).alias("from_clock"),
        _r4(S.lap_text_to_seconds(F.format_string("%.2f", F.col("value")))).alias("from_plain"),
        _r4(S.lap_text_to_seconds(F.concat(F.lit("x:"), F.col("value").cast("string")))).alias("malformed"),
    )


def numeric_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    return e.select(
        "event_id",
        _r4(S.text_to_double(F.concat(F.lit("+"), F.format_string("%.3f", F.col("value"))))).alias("gap"),
        _r4(S.text_to_double(F.concat(k, F.lit(" LAP")))).alias("laps_behind"),
        _r4(S.text_to_double(F.concat(F.lit("LAP "), k))).alias("no_number"),
        _r4(S.text_to_double(F.format_string("-%.2f", F.col("value")))).alias("negative"),
        S.text_to_int(F.concat(F.lit(" "), k, F.lit("0.7"))).alias("wind"),
    )


def clock_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    iso = F.date_format("ts", V.ISO_FORMAT)
    return e.select("event_id", (S.iso_clock_millis(iso) / 1000.0).alias("clock"))


# --- feed parsing and routing (P1-P10 J1 S4 S6 F9 F11) ----------------------

def feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = V.capture_lines(None, _numbered(spark, sf_dir))
    return E.classify(lines).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_lines(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def _roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster document is derived from events, written to the shared
    folder and read back like the season document."""
    path = scratch_path(spark, "roster")
    V.roster_document(_events(spark, sf_dir)).coalesce(1).write.mode("overwrite").text(path)
    return E.roster_numbers(C.read_roster(spark, path))


def roster_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster(spark, sf_dir).select(F.col("pos").cast("int").alias("pos"), "pilot")


def line_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = _roster(spark, sf_dir)
    lines = _feed_lines(spark, sf_dir, roster=roster).where(F.col("route") != "weather")
    return lines.select("event_id", "PilotNumber", "route")


def best_lap_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _feed_lines(spark, sf_dir, gate="best_lap")
    return lines.select("event_id", "PilotNumber", "route")


def recap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = V.recap_messages(None, _numbered(spark, sf_dir))
    lines = E.normalise(msgs)
    text = F.col("line.LastLapTime.Value")
    return lines.select(
        "event_id",
        "PilotNumber",
        F.col("line.NumberOfLaps").try_cast("int").alias("Lap"),
        _r4(S.lap_text_to_seconds(text)).alias("recap_seconds"),
        text.try_cast("double").alias("Seconds"),
        "route",
    )


def concat_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture documents written back to back (files of <= 1000 events),
    read with the splittable ``}{`` reader, classified."""
    docs = V.capture_lines(None, _numbered(spark, sf_dir)).where(F.col("value").contains("{"))
    path = scratch_path(spark, "concat")
    C.write_concatenated(
        docs.withColumn("_file", F.floor(F.col("event_id") / DOCS_PER_FILE)), path, ["event_id", "part"], "_file"
    )
    msgs = E.classify(C.read_concatenated(spark, path))
    # Nullable integers are returned as DOUBLE so both engines print them alike.
    return msgs.select(
        "kind",
        "topic",
        E.first_driver().try_cast("int").cast("double").alias("PilotNumber"),
        S.instant_millis(S.iso_to_timestamp(F.col("msg_time"))).cast("double").alias("ts_ms"),
    )


def literal_payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = V.literal_payloads(None, _numbered(spark, sf_dir))
    schema = (
        "NumberOfLaps INT, LastLapTime STRUCT<Value: STRING, PersonalFastest: BOOLEAN>, "
        "Retired STRING, PilotNumber STRING"
    )
    p = lines.select(F.from_json(S.py_literal_to_json(F.col("value")), schema).alias("p"))
    return p.select(
        F.col("p.PilotNumber").try_cast("int").alias("PilotNumber"),
        F.col("p.NumberOfLaps").alias("Lap"),
        _r4(S.lap_text_to_seconds(F.col("p.LastLapTime.Value"))).alias("Seconds"),
        F.col("p.LastLapTime.PersonalFastest").alias("fastest"),
        F.col("p.Retired").alias("retired"),
    )


# --- pacing (W2 P21 F4) ------------------------------------------------------

def _messages(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(
        "event_id",
        F.col("user_id").cast("int").alias("PilotNumber"),
        S.utc_instant("ts").alias(TS),
        F.date_format("ts", V.ISO_FORMAT).alias("iso"),
    )


def interarrival_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = P.interarrival(_messages(spark, sf_dir), ["PilotNumber"], TS, order=[TS, "event_id"])
    return d.select("event_id", "PilotNumber", _r4("delta").alias("delta"))


def interarrival_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = P.interarrival(_messages(spark, sf_dir), ["PilotNumber"], TS, order=[TS, "event_id"], mode="clock", iso_text="iso")
    return d.select("event_id", "PilotNumber", _r4("delta").alias("delta"))


def interarrival_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 over the whole feed as one session (one capture file = one session):
    no key, so above a million rows the sequence is range-split across tasks."""
    d = P.interarrival(_messages(spark, sf_dir), [], TS, order=[TS, "event_id"])
    return d.select("event_id", _r4("delta").alias("delta"))


def bounded_gap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = P.interarrival(_messages(spark, sf_dir), ["PilotNumber"], TS, order=[TS, "event_id"])
    return P.bounded_gap_filter(d, FIXTURE_MAX_DELTA).select("event_id", "PilotNumber", _r4("delta").alias("delta"))


def replay_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 over a whole capture: feed paced per session, recap/empty bypass."""
    lines = V.capture_lines(None, _numbered(spark, sf_dir))
    msgs = materialize(E.classify(lines).select("event_id", "part", "PilotNumber", "ts", "kind", "msg_time"))
    sched = P.replay_schedule(msgs, ["PilotNumber"], ["ts", "event_id"], max_delta=FIXTURE_MAX_DELTA)
    return sched.select("event_id", "part", "kind", _r4("delta").alias("delta"), "sent")


# --- dashboard (D1-D6 A5 W4 U2) ----------------------------------------------

def pace_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = D.pace_trace(_feed_laps(spark, sf_dir), tiebreak=["event_id"])
    return t.select("lap_bucket", "pilot_bucket", _r4("seconds").alias("seconds"))


def pace_trace_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with its linear fit, over laps seven apart (its buckets have gaps)."""
    laps = V.laps_from_events(None, stride=7, numbered=_numbered(spark, sf_dir).where("event_type in ('click', 'view')"))
    t = D.pace_trace_fitted(materialize(laps), tiebreak=["event_id"])
    # interpolated hundredths often end in a 5: nine places leave no tie to round
    return t.select("lap_bucket", "pilot_bucket", F.round("seconds", 9).alias("seconds"), "known")


def pace_trace_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = V.laps_from_events(None, stride=3, numbered=_numbered(spark, sf_dir))
    f = D.linear_fill(laps)
    return f.select("PilotNumber", "Lap", _r4("Seconds").alias("Seconds"), "known")


def race_pace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = D.race_pace_table(_feed_laps(spark, sf_dir), tiebreak=["event_id"])
    return t.select("pilot_bucket", _r4("seconds").alias("seconds"))


#: Overlapping ranges of a two-range table panel, one with its own label.
TWO_RANGES = (D.Range(0, 40, "early"), D.Range(20, 1000))


def race_pace_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 with the range's label as a column (A6), for the panel's own range."""
    t = D.range_panel(_feed_laps(spark, sf_dir), "PilotNumber", "Lap", "Seconds", D.AUTO_MAX_BARS, tiebreak=["event_id"])
    return D.labelled(t, D.PANEL_RANGES, "seconds").select("range_label", "pilot_bucket", _r4("seconds").alias("seconds"))


def race_pace_two_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 over two overlapping ranges, transposed: a column for each range."""
    t = D.range_panel(_feed_laps(spark, sf_dir), "PilotNumber", "Lap", "Seconds", D.AUTO_MAX_BARS, TWO_RANGES, ["event_id"])
    return t.select("pilot_bucket", *[_r4(F.col(f"`{r.label}`")).alias(n) for r, n in zip(TWO_RANGES, ("early", "from_20"))])


def prediction_two_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 over the same two ranges of NextLap, in the long form with labels."""
    pred = _feed_predictions(spark, sf_dir)
    t = D.range_panel(pred, "PilotN", "NextLap", "prediction", D.LINE_MAX_BARS, TWO_RANGES, ["NextLap"])
    return D.labelled(t, TWO_RANGES, "prediction").select("range_label", "pilot_bucket", _r4("prediction").alias("prediction"))


def race_lap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.race_lap(_feed_laps(spark, sf_dir, reused=False))


def _feed_predictions(spark, sf_dir, laps=None, reused: bool = True):
    """Predictions over the feed laps; written once when several actions
    (interval aggregate, final query) read them."""
    laps = laps if laps is not None else _feed_laps(spark, sf_dir)
    pred = regress.rolling_predict(laps, tiebreak=("event_id",))
    return materialize(pred) if reused else pred


def prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = D.prediction_table(_feed_predictions(spark, sf_dir), tiebreak=["NextLap"])
    return t.select("pilot_bucket", _r4("prediction").alias("prediction"))


def gap_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = materialize(E.gap_rows(_feed_lines(spark, sf_dir)))
    t = D.gap_bars(g, tiebreak=["event_id"])
    return t.select("pilot_bucket", _r4("gap_to_previous").alias("gap_to_previous"), _r4("gap_to_leader").alias("gap_to_leader"))


def weather_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = E.weather_rows(_feed_lines(spark, sf_dir))
    t = D.weather_latest(w, tiebreak=["event_id"])
    return t.select(*[_r4(c).alias(c) for c in D.WEATHER_PANEL])


def unified_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one parse of the feed feeds all four collections
    lines = materialize(
        _feed_lines(spark, sf_dir).select("event_id", "kind", "msg_time", "PilotNumber", "line", "weather", "route")
    )
    laps = E.lap_rows(lines).select("PilotNumber", "Lap", "Seconds", TS, "event_id")
    v = D.unified_view(
        laps=laps,
        predictions=_feed_predictions(spark, sf_dir, laps, reused=False),
        gaps=E.gap_rows(lines),
        weather=E.weather_rows(lines),
    )
    doubles = ["Seconds", "prediction", "gap_to_leader", "gap_to_previous", "AirTemp", "Humidity", "Pressure",
               "Rainfall", "TrackTemp", "WindSpeed"]
    ints = ["PilotNumber", "Lap", "PilotN", "NextLap", "gap_pilot", "WindDirection"]
    # Nullable integers are returned as DOUBLE so both engines print them alike.
    return v.select(
        "collection", _ms(), *[F.col(c).cast("double").alias(c) for c in ints], *[_r4(c).alias(c) for c in doubles]
    )


#: The data view of the dashboard's first panel.
VIEW_PATTERN = "gaps,lastlaptimes,others,predictions*"


def unified_view_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collections resolved by the panel's wildcard and read as one
    view.  A fifth collection (predictions of the older job, with a wider
    NextLap and a narrower prediction) is picked up; one the pattern does not
    name is left out."""
    root = scratch_path(spark, "catalogue")
    lines = materialize(
        _feed_lines(spark, sf_dir).select("event_id", "kind", "msg_time", "PilotNumber", "line", "weather", "route")
    )
    laps = materialize(E.lap_rows(lines).select("PilotNumber", "Lap", "Seconds", TS, "event_id"))
    older = regress.rolling_predict(laps, tiebreak=("event_id",), n=regress.OLDER["n"], cadence=regress.OLDER["cadence"])
    for name, df in {
        SK.LAPS_TABLE: laps,
        SK.GAPS_TABLE: E.gap_rows(lines),
        SK.WEATHER_TABLE: E.weather_rows(lines),
        SK.PREDICTIONS_TABLE: _feed_predictions(spark, sf_dir, laps, reused=False).select("PilotN", "NextLap", "prediction", TS),
        f"{SK.PREDICTIONS_TABLE}-older": older.select(
            "PilotN", F.col("NextLap").cast("long").alias("NextLap"), F.col("prediction").cast("float").alias("prediction"), TS
        ),
        "bronze": lines.select("kind"),
    }.items():
        df.write.parquet(f"{root}/{name}")
    v = CollectionCatalog(spark, root).view(VIEW_PATTERN)
    return v.select(
        "collection", _ms(),
        *[F.col(c).cast("double").alias(c) for c in ("PilotNumber", "Lap", "PilotN", "NextLap")],
        _r4("Seconds").alias("Seconds"), _r4("prediction").alias("prediction"),
        _r4(F.col("Gaps.GapToLeader")).alias("gap_to_leader"), _r4(F.col("Weather.AirTemp")).alias("AirTemp"),
    )


def keyed_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = L.keyed_records(L.lap_messages(_feed_laps(spark, sf_dir, reused=False)))
    back = L.parse_lap_messages(recs)
    return back.select("key", "PilotNumber", "Lap", _r4("Seconds").alias("Seconds"), _ms())


def lap_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = _feed_laps(spark, sf_dir)
    iv = D.histogram_interval(laps, "Lap", D.LINE_MAX_BARS)
    return laps.groupBy(D.bucket("Lap", iv).alias("lap_bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- streaming (ST1-ST8 S5 S7-S10) -------------------------------------------

# Replayed streams arrive in event-time waves, each processed before the
# next is written.  The number of waves grows with the data so one wave (and
# a hot driver's share of it, which one task writes) stays bounded.
MIN_STREAM_WAVES = 4
WAVE_ROWS = 5_000_000
FILES_PER_TRIGGER = 8


def _in_waves(msgs: DataFrame, path: str, run, ts: str = TS, waves: int = MIN_STREAM_WAVES, folder: str | None = None) -> None:
    """Replay ``value`` lines into ``path`` in event-time waves: each wave is
    written (each file holding whole drivers of the wave) and then processed
    by ``run()`` -- an ``availableNow`` run on the same checkpoint -- before
    the next wave is written.  Order never depends on file times, and every
    run after the first restarts the query from its checkpoint and state.
    Lines of each value of ``folder`` go to a folder of their own."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    own = F.lit(None).cast("string") if folder is None else F.col(folder).cast("string")
    msgs = materialize(msgs.select("PilotNumber", micros.alias("at"), own.alias("own"), "value"))
    lo, hi, rows = msgs.agg(F.min("at"), F.max("at"), F.count(F.lit(1))).first()
    waves = max(waves, -(-rows // WAVE_ROWS)) if lo is not None else 1
    step = max(1, -(-(hi - lo + 1) // waves)) if lo is not None else 1
    # rows without a time come with the first wave
    wave = F.coalesce(F.floor((F.col("at") - F.lit(lo or 0)) / F.lit(step)), F.lit(0)).cast("int")
    # Written once by wave: every run below reads its own folder only.
    cut = scratch_path(msgs.sparkSession, "waves")
    msgs.withColumn("wave", wave).repartition("wave", "PilotNumber").write.partitionBy("wave").parquet(cut)
    cut = msgs.sparkSession.read.schema("PilotNumber int, at long, own string, value string, wave int").parquet(cut)
    for i in range(waves):
        wave = cut.where(F.col("wave") == i).repartition("PilotNumber")
        if folder is None:
            wave.select("value").write.mode("append").text(path)
        else:
            wave.select("value", "own").write.mode("append").partitionBy("own").text(path)
        run()


def _lap_messages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus lap messages of every event."""
    return L.lap_messages(V.laps_from_events(None, numbered=_numbered(spark, sf_dir)))


def _streamed_predictions(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """ST1-ST6 + S7: file stream of bus lap messages -> keyed-state predictor
    -> per-batch prediction table."""
    src, out, ck = (scratch_path(spark, n) for n in ("lap-stream", "predictions", "predictions-ckpt"))

    def run():
        laps = L.parse_lap_messages(C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER))
        with SP.use_rocksdb(spark), state_partitions(spark):
            SK.run_available(SP.predict_stream(laps), ck, fn=SK.batch_writer(out))

    _in_waves(messages, src, run)
    return spark.read.parquet(out)


def stream_rolling_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed predictions of laps in order; equals the batch flagship."""
    res = _streamed_predictions(spark, _lap_messages_of(spark, sf_dir))
    return res.select(F.col("PilotN").alias("PilotNumber"), "NextLap", _r4("prediction").alias("prediction"))


def stream_late_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: the streamed predictions of laps that come late; equals the batch
    predictor in arrival order."""
    res = _streamed_predictions(spark, L.lap_messages(V.late_laps(_numbered(spark, sf_dir))))
    return res.select(F.col("PilotN").alias("PilotNumber"), "Lap", "NextLap", _r4("prediction").alias("prediction"))


def stream_latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: continuously updated last lap time per driver (complete mode)."""
    src, out, ck = (scratch_path(spark, n) for n in ("lap-stream", "latest", "latest-ckpt"))

    def snapshot(df, batch_id):
        df.write.mode("overwrite").parquet(out)

    def run():
        laps = L.parse_lap_messages(C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER))
        with state_partitions(spark):
            SK.run_available(SK.latest_per_driver(laps), ck, fn=snapshot, output_mode="complete")

    _in_waves(_lap_messages_of(spark, sf_dir), src, run)
    res = spark.read.parquet(out)
    return res.select("PilotNumber", _r4("seconds").alias("seconds"), "Lap")


def stream_three_way_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8 + S8-S10: raw feed file stream split into the lap, gap and weather
    collections by one foreachBatch; returns rows per collection."""
    src = scratch_path(spark, "feed-stream")
    C.write_lines(V.feed_messages(None, _numbered(spark, sf_dir)), src)
    root = scratch_path(spark, "collections")
    raw = C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER)
    SK.run_available(raw, scratch_path(spark, "split-ckpt"), fn=SK.three_way_split(root))
    parts = [
        spark.read.parquet(f"{root}/{t}").select(F.lit(t).alias("collection"))
        for t in (SK.LAPS_TABLE, SK.GAPS_TABLE, SK.WEATHER_TABLE)
    ]
    allrows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return allrows.groupBy("collection").agg(F.count(F.lit(1)).alias("n"))


def stream_live_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live system over a raw feed stream: bronze capture, three-way split
    and keyed-state predictor started together; returns the predictions."""
    src, root, ck = (scratch_path(spark, n) for n in ("live-feed", "live", "live-ckpt"))

    def run():
        raw = C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER)
        with SP.use_rocksdb(spark), state_partitions(spark):
            for q in SK.start_live(raw, root, ck):
                q.awaitTermination()
                if q.exception() is not None:
                    raise q.exception()

    _in_waves(V.feed_messages(None, _numbered(spark, sf_dir)), src, run, ts="ts")
    res = spark.read.parquet(f"{root}/{SK.PREDICTIONS_TABLE}")
    return res.select(F.col("PilotN").alias("PilotNumber"), "NextLap", _r4("prediction").alias("prediction"))


def stream_two_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + F6 + P15: the live system over two captures in which the same cars
    drive (events of even and of odd id).  Each session has its own state and
    predictions, stored as documents: FLOAT, event time and processing time;
    ``stamped`` says that each micro-batch holds one processing time."""
    src, root, ck = (scratch_path(spark, n) for n in ("session-feeds", "live", "live-ckpt"))

    def run():
        raw = C.read_lines(spark, src, stream=True, max_files=2 * FILES_PER_TRIGGER, sessions=True)
        with SP.use_rocksdb(spark), state_partitions(spark):
            for q in SK.start_live(raw, root, ck, documents=True):
                q.awaitTermination()
                if q.exception() is not None:
                    raise q.exception()

    feed = V.feed_messages(None, _numbered(spark, sf_dir)).withColumn("capture", F.col("event_id") % 2)
    _in_waves(feed, src, run, ts="ts", waves=2, folder="capture")
    res = spark.read.parquet(f"{root}/{SK.PREDICTIONS_TABLE}")
    one = res.groupBy("batch_id").agg((F.min(SK.STAMP) == F.max(SK.STAMP)).alias("stamped"))
    return res.join(one, "batch_id").select(
        F.regexp_extract("session", r"=(\d+)$", 1).cast("int").alias("session"), F.col("PilotN").alias("PilotNumber"), "Lap", "NextLap",
        _r4(F.col("prediction").cast("double")).alias("prediction"), _ms(), "stamped",
    )


def stream_bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + S12 + F7: laps sent to the bus by micro-batches, each of which is
    written twice as after a failure, and read back once by record identity.
    A folder stands for the topic."""
    src, topic, out, ck = (scratch_path(spark, n) for n in ("laps", "topic", "bus-laps", "bus-ckpt"))
    _feed_laps(spark, sf_dir, reused=False).drop("event_id").write.parquet(src)
    laps = spark.readStream.schema(f"PilotNumber int, Lap int, Seconds double, `{TS}` timestamp").option("maxFilesPerTrigger", "4").parquet(src)

    def twice(df: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            SK.bus_records(df, batch_id).select("key", "value", "headers").write.mode("append").parquet(topic)

    SK.run_available(laps, f"{ck}/out", fn=twice)
    bus = spark.readStream.schema("key string, value string, headers array<struct<key: string, value: binary>>").parquet(topic)
    parsed = L.parse_lap_messages(SK.record_ids(bus).drop("headers"))
    with state_partitions(spark):
        SK.run_available(SK.once(parsed, TS, "40 days"), f"{ck}/in", fn=SK.batch_writer(out))
    return spark.read.parquet(out).select("key", "PilotNumber", "Lap", _r4("Seconds").alias("Seconds"), _ms())


def _split_store(spark: SparkSession, sf_dir: str) -> dict[str, ST.CollectionStore]:
    """The three collections of a streamed feed, in stores by day: split in
    micro-batches, then compacted."""
    src, root = scratch_path(spark, "feed-stream"), scratch_path(spark, "stores")
    C.write_lines(V.feed_messages(None, _numbered(spark, sf_dir)), src)
    raw = C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER // 2)
    stores = {t: ST.CollectionStore(spark, f"{root}/{t}") for t in (SK.LAPS_TABLE, SK.GAPS_TABLE, SK.WEATHER_TABLE)}
    SK.run_available(raw, scratch_path(spark, "split-ckpt"), fn=SK.three_way_split(root, stores=stores))
    for store in stores.values():
        store.compact()
    return stores


def _contents(stores: dict[str, ST.CollectionStore], lo=None, hi=None) -> DataFrame:
    read = {t: s.read(lo, hi) for t, s in stores.items()}
    v = D.unified_view(laps=read[SK.LAPS_TABLE], gaps=read[SK.GAPS_TABLE], weather=read[SK.WEATHER_TABLE])
    doubles = ["Seconds", "gap_to_leader", "gap_to_previous", "AirTemp", "Humidity", "Pressure", "Rainfall", "TrackTemp", "WindSpeed"]
    ints = ["PilotNumber", "Lap", "gap_pilot", "WindDirection"]
    return v.select("collection", _ms(), *[F.col(c).cast("double").alias(c) for c in ints], *[_r4(c).alias(c) for c in doubles])


def stream_split_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8 + S8-S10: the rows of the lap, gap and weather collections that the
    split of a streamed feed wrote, after compaction."""
    return _contents(_split_store(spark, sf_dir))


#: A time range of the dashboards: [lo, hi).
TIME_RANGE = ("2024-01-08 00:00:00", "2024-01-15 12:00:00")


def dashboards_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: the stored collections of one time range, by day folders and row
    groups."""
    utc = lambda text: datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return _contents(_split_store(spark, sf_dir), *[utc(t) for t in TIME_RANGE])


def _panel_stream(spark: SparkSession, sf_dir: str, panel: PN.Panel, rows_of) -> DataFrame:
    """ST7: a panel's unit buckets updated by a streamed feed in waves; the
    state's rows are those of the table it leaves."""
    src, root, ck = (scratch_path(spark, n) for n in ("feed-stream", "panels", "panel-ckpt"))

    def run():
        raw = C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER)
        with state_partitions(spark):
            updates = PN.state(rows_of(E.normalise(raw)), panel)
            SK.run_available(updates, ck, fn=SK.batch_writer(f"{root}/{panel.name}"), output_mode="update")

    _in_waves(V.feed_messages(None, _numbered(spark, sf_dir)), src, run, ts="ts", waves=2)
    return PN.merged(PN.read(spark, root, panel), panel)


def stream_race_pace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 from streamed state."""
    states = materialize(_panel_stream(spark, sf_dir, PN.RACE_PACE, E.lap_rows))
    return PN.table(states, PN.RACE_PACE).select("pilot_bucket", _r4("seconds").alias("seconds"))


def stream_gap_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 from streamed state."""
    t = PN.bars(materialize(_panel_stream(spark, sf_dir, PN.GAPS, E.gap_rows)))
    return t.select("pilot_bucket", _r4("gap_to_previous").alias("gap_to_previous"), _r4("gap_to_leader").alias("gap_to_leader"))


def stream_weather_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 from streamed state."""
    t = PN.latest(_panel_stream(spark, sf_dir, PN.WEATHER, E.weather_rows))
    return t.select(*[_r4(c).alias(c) for c in D.WEATHER_PANEL])


def stream_prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 from streamed state: the predictions collection, itself written by
    micro-batches, read as a stream."""
    pred = scratch_path(spark, "predictions")
    _feed_predictions(spark, sf_dir, reused=False).select("PilotN", "NextLap", "prediction", TS).write.parquet(pred)
    root, ck = scratch_path(spark, "panels"), scratch_path(spark, "panel-ckpt")
    rows = spark.readStream.schema(f"PilotN int, NextLap int, prediction double, `{TS}` timestamp").option("maxFilesPerTrigger", "2").parquet(pred)
    with state_partitions(spark):
        updates = PN.state(rows, PN.PREDICTION, ["NextLap"])
        SK.run_available(updates, ck, fn=SK.batch_writer(f"{root}/{PN.PREDICTION.name}"), output_mode="update")
    states = materialize(PN.merged(PN.read(spark, root, PN.PREDICTION), PN.PREDICTION))
    return PN.table(states, PN.PREDICTION).select("pilot_bucket", _r4("prediction").alias("prediction"))


def stream_bronze_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw capture stream appended to a bronze table without heartbeats
    (file sink, exactly-once); returns lines per kind."""
    src = scratch_path(spark, "capture-stream")
    C.write_lines(V.capture_lines(None, _numbered(spark, sf_dir)), src)
    out = scratch_path(spark, "bronze")
    raw = C.read_lines(spark, src, stream=True, max_files=FILES_PER_TRIGGER)
    SK.run_available(SK.bronze(raw), scratch_path(spark, "bronze-ckpt"), path=out)
    return E.classify(spark.read.parquet(out)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Query] = {
    "rolling_lap_prediction": rolling_lap_prediction,
    "rolling_lap_prediction_n5": rolling_lap_prediction_n5,
    "lap_buffer_top10": lap_buffer_top10,
    "lap_buffer_top5": lap_buffer_top5,
    "next_lap_per_driver": next_lap_per_driver,
    "driver_ridge_fit": driver_ridge_fit,
    "driver_score_join": driver_score_join,
    "parse_lap_value": parse_lap_value,
    "lap_text_to_seconds": lap_text_to_seconds,
    "numeric_convert": numeric_convert,
    "clock_number": clock_number,
    "feed_filter": feed_filter,
    "route_counts": route_counts,
    "line_fanout": line_fanout,
    "best_lap_gate": best_lap_gate,
    "recap_lines": recap_lines,
    "roster_normalise": roster_normalise,
    "concat_json_split": concat_json_split,
    "literal_payload_parse": literal_payload_parse,
    "interarrival_gap": interarrival_gap,
    "interarrival_clock": interarrival_clock,
    "interarrival_global": interarrival_global,
    "bounded_gap_filter": bounded_gap_filter,
    "replay_schedule": replay_schedule,
    "pace_trace": pace_trace,
    "pace_trace_filled": pace_trace_filled,
    "pace_trace_fitted": pace_trace_fitted,
    "late_lap_prediction": late_lap_prediction,
    "race_pace_labelled": race_pace_labelled,
    "race_pace_two_ranges": race_pace_two_ranges,
    "prediction_two_ranges": prediction_two_ranges,
    "unified_view_pattern": unified_view_pattern,
    "stream_late_laps": stream_late_laps,
    "race_pace_table": race_pace_table,
    "race_lap": race_lap,
    "prediction_table": prediction_table,
    "gap_bars": gap_bars,
    "weather_latest": weather_latest,
    "unified_view": unified_view,
    "keyed_json_sink": keyed_json_sink,
    "lap_histogram": lap_histogram,
    "stream_rolling_prediction": stream_rolling_prediction,
    "stream_latest_value": stream_latest_value,
    "stream_three_way_split": stream_three_way_split,
    "stream_bronze_capture": stream_bronze_capture,
    "stream_live_system": stream_live_system,
    "stream_bus_records": stream_bus_records,
    "stream_two_sessions": stream_two_sessions,
    "stream_split_contents": stream_split_contents,
    "dashboards_time_range": dashboards_time_range,
    "stream_race_pace_table": stream_race_pace_table,
    "stream_prediction_table": stream_prediction_table,
    "stream_gap_bars": stream_gap_bars,
    "stream_weather_latest": stream_weather_latest,
}
