"""Lineage cuts for intermediates that several actions read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitwall.config import checkpoint_root, scratch_path


def materialize(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder named by
    ``spark.checkpoint.dir`` and read it back.  Later size checks, interval
    aggregates and the final query then scan only the columns they need, with
    their predicates pushed down, instead of recomputing the plan; a lost
    executor costs a re-read, not a recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Like :func:`materialize`, as a reliable checkpoint: it keeps how ``df``
    is partitioned and sorted, so a window over that layout needs no shuffle."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
