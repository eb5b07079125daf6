"""Command line: run the live system over a feed and show the dashboard.

    python -m pitwall live --feed DIR --out DIR [--concatenated] [--files-per-batch N]
                           [--roster FILE] [--every "5 seconds"] [--sessions]
    python -m pitwall dashboards --out DIR

``live`` starts bronze capture, the three-way split and the predictor over a
folder of feed captures (one message per line, or concatenated JSON); without
``--every`` it processes what is there and stops.  ``dashboards`` prints the
six dashboard panels from the collections under ``--out``.  Works under
``spark-submit`` (it uses the active session; checkpoints go under
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def live(spark: SparkSession, feed: str, out: str, concatenated: bool = False, files_per_batch: int = 8,
         roster: str | None = None, every: str | None = None, checkpoints: str | None = None,
         roster_limit: int | None = 20, sessions: bool = False) -> None:
    """Run the live system.  ``checkpoints`` (default ``{out}/_checkpoints``)
    belongs to ``out``: a restart with both goes on where the last run ended."""
    from pitwall.config import state_partitions
    from pitwall.operators.envelope import roster_numbers
    from pitwall.sources import capture as C
    from pitwall.streaming import predictor as SP
    from pitwall.streaming import sinks as SK

    if concatenated:
        raw = spark.readStream.format("text").option("lineSep", C.SEPARATOR).option("maxFilesPerTrigger", str(files_per_batch))
        raw = C.with_session(raw.option("recursiveFileLookup", "true").load(feed)) if sessions else raw.load(feed)
        raw = raw.withColumn("value", C.repair_split_record("value"))
    else:
        raw = C.read_lines(spark, feed, stream=True, max_files=files_per_batch, sessions=sessions)
    r = roster_numbers(C.read_roster(spark, roster), limit=roster_limit) if roster else None
    with SP.use_rocksdb(spark), state_partitions(spark):
        queries = SK.start_live(raw, out, checkpoints or f"{out.rstrip('/')}/_checkpoints", roster=r, processing_time=every, documents=True)
        try:
            while any(q.isActive for q in queries):
                spark.streams.resetTerminated()
                failed = [q.exception() for q in queries if q.exception() is not None]
                if failed:
                    raise failed[0]
                if any(q.isActive for q in queries):
                    spark.streams.awaitAnyTermination(10)
            failed = [q.exception() for q in queries if q.exception() is not None]
            if failed:
                raise failed[0]
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()


def dashboards(spark: SparkSession, out: str) -> dict:
    from pitwall.operators import dashboard as D
    from pitwall.streaming.sinks import read_collections

    col = read_collections(spark, out)
    panels = {
        "pace_trace": D.pace_trace(col["laps"]),
        "race_pace_table": D.race_pace_table(col["laps"]),
        "race_lap": D.race_lap(col["laps"]),
        "gap_bars": D.gap_bars(col["gaps"]),
        "weather_latest": D.weather_latest(col["weather"]),
    }
    if "predictions" in col:
        panels["prediction_table"] = D.prediction_table(col["predictions"])
    return panels


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m pitwall")
    sub = p.add_subparsers(dest="cmd", required=True)
    lv = sub.add_parser("live", help="run the live system over a feed folder")
    lv.add_argument("--feed", required=True)
    lv.add_argument("--out", required=True)
    lv.add_argument("--concatenated", action="store_true")
    lv.add_argument("--files-per-batch", type=int, default=8)
    lv.add_argument("--sessions", action="store_true", help="FEED holds one folder for each session")
    lv.add_argument("--roster")
    lv.add_argument("--every")
    lv.add_argument("--checkpoints", help="folder of the streams' progress (default: OUT/_checkpoints)")
    lv.add_argument("--roster-limit", type=int, default=20, help="entries of the roster that count; 0: all")
    db = sub.add_parser("dashboards", help="write the dashboard panels")
    db.add_argument("--out", required=True)
    db.add_argument("--panels", help="folder for the panels (default: OUT/_panels)")
    db.add_argument("--show", type=int, default=0, help="also print this many rows of each panel")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("pitwall").config("spark.sql.variant.allowDuplicateKeys", "true").getOrCreate()
    if a.cmd == "live":
        live(spark, a.feed, a.out, a.concatenated, a.files_per_batch, a.roster, a.every, a.checkpoints, a.roster_limit or None, a.sessions)
    else:
        for name, df in dashboards(spark, a.out).items():
            path = f"{(a.panels or a.out.rstrip('/') + '/_panels').rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            print(f"{name}: {path}")
            if a.show:
                spark.read.parquet(path).show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
