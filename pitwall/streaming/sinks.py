"""Streaming sinks and the three-way split (ST1, ST2, ST7, ST8, S5, S7-S12, S14).

``foreachBatch`` is at-least-once: every sink here writes a micro-batch into
its own ``batch_id=<id>`` folder with mode overwrite, so a retried batch
replaces its own output instead of duplicating it.  Checkpoints live in the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators import envelope as E
from pitwall.operators.dashboard import last_value
from pitwall.operators.laps import TOPIC, keyed_records, lap_messages
from pitwall.schemas import TS

# Fixed values of the collections.
LAPS_TABLE = "lastlaptimes"
GAPS_TABLE = "gaps"
WEATHER_TABLE = "others"
PREDICTIONS_TABLE = "predictions"
HEARTBEAT = "{}"


def batch_writer(path: str, fmt: str = "parquet", prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """Idempotent per-batch writer for ``foreachBatch``; ``prepare`` shapes the
    batch before it is written."""

    def write(df: DataFrame, batch_id: int) -> None:
        df = prepare(df) if prepare else df
        df.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def three_way_split(root: str, roster: DataFrame | None = None, route_scope: str = "message", stores: dict | None = None):
    """ST8 + S8-S10: a ``foreachBatch`` function that routes raw feed lines of
    one micro-batch into the lap, gap and weather collections under ``root``, or
    into the ``CollectionStore`` that ``stores`` has for a collection.
    The batch is parsed once and persisted while the three writers read it."""
    writers = {t: batch_writer(f"{root}/{t}") for t in (LAPS_TABLE, GAPS_TABLE, WEATHER_TABLE)}
    writers |= {t: store.write_batch for t, store in (stores or {}).items()}

    def split(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # A2: nothing arrived in this trigger
            return
        lines = E.normalise(batch, roster=roster, route_scope=route_scope).persist()
        try:
            writers[LAPS_TABLE](E.lap_rows(lines), batch_id)
            writers[GAPS_TABLE](E.gap_rows(lines), batch_id)
            writers[WEATHER_TABLE](E.weather_rows(lines), batch_id)
        finally:
            lines.unpersist()

    return split


STAMP = "processed_at"


def prediction_documents(pred: DataFrame) -> DataFrame:
    """F6 + P15: predictions as they are stored: ``prediction`` as FLOAT, the
    event time, and next to it the processing time -- one moment for a whole
    micro-batch, taken when it is written."""
    keys = [c for c in ("session",) if c in pred.columns]
    return pred.select(
        *keys, F.col("PilotN").cast("int").alias("PilotN"), "Lap", "NextLap",
        F.col("prediction").cast("float").alias("prediction"), TS, F.current_timestamp().alias(STAMP),
    )


def latest_per_driver(laps: DataFrame, key: str = "PilotNumber") -> DataFrame:
    """ST7: continuously updated last lap time per driver (bounded state: one
    row per driver).  Use with output mode ``update`` or ``complete``."""
    return laps.groupBy(key).agg(last_value("Seconds").alias("seconds"), F.max("Lap").alias("Lap"))


def bronze(raw: DataFrame) -> DataFrame:
    """The raw capture minus heartbeats."""
    return raw.where(F.col("value") != HEARTBEAT)


RECORD_ID = "id"
#: How long after a record its repetition is recognised.
RETRY_WINDOW = "10 minutes"


def bus_records(laps: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Lap documents as bus records (key ``info``, JSON value).  With
    ``batch_id`` each record has an identity, also as a header: the batch, the
    digest of its value and its place among equal values of the batch -- so a
    batch that is written again, in whatever order, gives the same identities."""
    records = keyed_records(lap_messages(laps))
    if batch_id is None:
        return records
    digest = F.sha2("value", 256)
    nth = F.row_number().over(Window.partitionBy("_digest").orderBy("_digest"))
    records = records.withColumn("_digest", digest).withColumn("_nth", nth)
    identity = F.concat_ws("-", F.lit(str(batch_id)), "_digest", F.col("_nth").cast("string"))
    header = F.array(F.struct(F.lit(RECORD_ID).alias("key"), F.encode(identity, "UTF-8").alias("value")))
    return records.select("key", "value", identity.alias(RECORD_ID), header.alias("headers"))


def bus_options(servers: str, topic: str = TOPIC, **options: str) -> dict[str, str]:
    """Options of a bus writer; secured variants pass ``kafka.*``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def bus_writer(servers: str, topic: str = TOPIC, **options: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that sends laps to the message bus (needs
    the Kafka connector) with record identities."""

    def write(laps: DataFrame, batch_id: int) -> None:
        records = bus_records(laps, batch_id).select("key", "value", "headers")
        records.write.format("kafka").options(**bus_options(servers, topic, **options)).save()

    return write


def once(records: DataFrame, ts: str, window: str = RETRY_WINDOW) -> DataFrame:
    """Reader side of S11/S12: records of a stream without the repetitions that
    come within ``window`` of ``ts``; the state forgets older identities.  All
    records must have one."""
    return records.withWatermark(f"`{ts}`", window).dropDuplicatesWithinWatermark([RECORD_ID])


def record_ids(bus: DataFrame) -> DataFrame:
    """Bus rows (``headers`` included) with the identity as a column."""
    found = F.filter("headers", lambda h: h["key"] == RECORD_ID)
    return bus.withColumn(RECORD_ID, F.decode(F.get(found, 0)["value"], "UTF-8"))


def console(df: DataFrame):
    """Debug printing of a stream."""
    return df.writeStream.format("console").option("truncate", "false").start()


def run_available(df: DataFrame, checkpoint: str, fn: Callable | None = None, output_mode: str = "append",
                  path: str | None = None, fmt: str = "parquet") -> None:
    """ST1: run a stream over everything available now (``availableNow``) and
    wait; either ``foreachBatch(fn)`` or a file sink at ``path``."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if fn is not None:
        q = w.foreachBatch(fn).start()
    else:
        q = w.format(fmt).option("path", path).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def start_live(
    raw: DataFrame,
    root: str,
    checkpoints: str,
    roster: DataFrame | None = None,
    route_scope: str = "message",
    processing_time: str | None = None,
    n: int = 10,
    cadence: int = 2,
    documents: bool = False,
) -> list:
    """Start the live system over one raw feed stream (``value`` text lines):

    * ``bronze``      -- S5 raw capture without heartbeats (file sink);
    * ``split``       -- ST8 laps / gaps / weather collections (foreachBatch);
    * ``predictions`` -- ST1-ST6 keyed-state predictor over the routed laps.

    Lines with a ``session`` column (see ``capture.with_session``) carry it into
    every collection, and a driver's state belongs to one session.  With
    ``documents`` predictions are stored as documents (``prediction_documents``).

    Each query has its own checkpoint under ``checkpoints`` (a folder in the
    shared ``spark.checkpoint.dir``).  ``processing_time`` (e.g. "5 seconds")
    sets a trigger; by default every query runs over what is available now
    and stops.  Returns the started ``StreamingQuery`` objects; the predictor
    needs the RocksDB state store (``use_rocksdb``) active when it starts.
    Bound each micro-batch on the source (``maxOffsetsPerTrigger`` /
    ``maxFilesPerTrigger``): one driver's rows of a batch meet in one task.
    """
    from pitwall.streaming.predictor import predict_stream

    def trig(w):
        return w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)

    started = []
    w = bronze(raw).writeStream.format("parquet").option("path", f"{root}/bronze")
    started.append(trig(w.option("checkpointLocation", f"{checkpoints}/bronze")).start())
    w = raw.writeStream.foreachBatch(three_way_split(root, roster=roster, route_scope=route_scope))
    started.append(trig(w.option("checkpointLocation", f"{checkpoints}/split")).start())
    laps = E.lap_rows(E.normalise(raw, roster=roster, route_scope=route_scope))
    key = ["session", "PilotNumber"] if "session" in laps.columns else "PilotNumber"
    preds = predict_stream(laps, key=key, n=n, cadence=cadence)
    write = batch_writer(f"{root}/{PREDICTIONS_TABLE}", prepare=prediction_documents if documents else None)
    w = preds.writeStream.outputMode("append").foreachBatch(write)
    started.append(trig(w.option("checkpointLocation", f"{checkpoints}/predictions")).start())
    return started


def read_collections(spark, root: str) -> dict[str, DataFrame]:
    """The collections written under ``root`` by :func:`three_way_split` /
    :func:`start_live`, ready for the dashboard queries (D1-D6, U2):
    ``laps``, ``gaps``, ``weather`` and, when present, ``predictions``."""
    from pyspark.errors import AnalysisException

    out = {
        "laps": spark.read.parquet(f"{root}/{LAPS_TABLE}"),
        "gaps": spark.read.parquet(f"{root}/{GAPS_TABLE}"),
        "weather": spark.read.parquet(f"{root}/{WEATHER_TABLE}"),
    }
    try:
        out["predictions"] = spark.read.parquet(f"{root}/{PREDICTIONS_TABLE}")
    except AnalysisException:  # no predictor wrote under this root
        pass
    return out
