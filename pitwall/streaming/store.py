"""Collections that many micro-batches write and readers read meanwhile (S7-S10,
P20): a layout by day under an atomic manifest, and its compaction.

::

    root/<collection>/_manifest/00000012.json    which entries count
    root/<collection>/data/entry=<id>/day=2024-01-31/part-*.parquet

A batch is written as an entry of its own and counts once a new manifest names
it.  Manifest files are numbered and made whole under another name, then
renamed to a number that does not exist yet: of two writers one wins, the other
reads the new manifest and tries again.  A batch that is retried replaces the
entry of its first attempt, so a reader sees each batch once.  ``compact``
rewrites many small entries as one, sorted by time within each day, and swaps
them in one manifest; readers see either form.  What no manifest names (a
writer that died half way, entries compacted away) is removed by ``vacuum``.

Readers take the entries of the newest manifest.  A time range becomes a
filter on the ``day`` folders and on ``@timestamp`` in the row groups.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.dashboard import time_filter
from pitwall.schemas import TS

DAY, ENTRY = "day", "entry"
#: Rows without a time lie in this day.
NO_DAY = "1970-01-01"
#: Tries of a commit against other writers.
TRIES = 20
#: Rows that one file of a compacted day holds, at most.
FILE_ROWS = 4_000_000


class CommitConflict(RuntimeError):
    """The entries a commit replaces are no longer those it read."""


@dataclass
class Manifest:
    version: int = 0
    #: entry id -> batches it holds
    entries: dict[str, list[int]] = field(default_factory=dict)
    schema: str | None = None

    def holding(self, batch: int) -> list[str]:
        return [e for e, batches in self.entries.items() if batch in batches]


class CollectionStore:
    """One collection.  ``ts`` names its time column."""

    def __init__(self, spark: SparkSession, path: str, ts: str = TS):
        self.spark, self.path, self.ts = spark, path.rstrip("/"), ts
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _children(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    # -- manifest ----------------------------------------------------------

    def manifest(self) -> Manifest:
        versions = [n for n in self._children("_manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not versions:
            return Manifest()
        stream = self._fs.open(self._at(f"_manifest/{versions[-1]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _put(self, m: Manifest) -> bool:
        """Make version ``m.version``; False if it exists already."""
        final = self._at(f"_manifest/{m.version:08d}.json")
        draft = self._at(f"_manifest/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()
        if not self._fs.exists(final) and self._fs.rename(draft, final):
            return True
        self._fs.delete(draft, False)
        return False

    def _commit(self, change) -> Manifest:
        """``change(manifest)`` gives the entries of the next version."""
        for _ in range(TRIES):
            now = self.manifest()
            following = Manifest(now.version + 1, *change(now))
            if self._put(following):
                return following
        raise CommitConflict(f"{TRIES} commits to {self.path} met other writers")

    # -- writing -----------------------------------------------------------

    def _write(self, df: DataFrame) -> str:
        entry = uuid.uuid4().hex
        day = F.coalesce(F.to_date(F.col(self.ts)), F.lit(NO_DAY).cast("date"))
        df.withColumn(DAY, day).write.partitionBy(DAY).parquet(f"{self.path}/data/{ENTRY}={entry}")
        return entry

    def write_batch(self, df: DataFrame, batch: int) -> None:
        """Add a micro-batch, or replace what an earlier attempt of it wrote.  A
        batch that a compaction has taken in was committed: it is not added
        again."""
        held = self.manifest().holding(batch)
        if any(len(self.manifest().entries[e]) > 1 for e in held):
            return
        entry = self._write(df)
        fields = df.schema

        def change(now: Manifest):
            if any(len(now.entries[e]) > 1 for e in now.holding(batch)):
                return now.entries, now.schema
            kept = {e: b for e, b in now.entries.items() if b != [batch]}
            return {**kept, entry: [batch]}, self._schema(now.schema, fields)

        self._commit(change)

    @staticmethod
    def _schema(known: str | None, fields: T.StructType) -> str:
        from pitwall.sources.collections import merged

        return merged([T.StructType.fromJson(json.loads(known)), fields]).json() if known else fields.json()

    def writer(self):
        """For ``foreachBatch``."""
        return self.write_batch

    # -- reading -----------------------------------------------------------

    def read(self, lo=None, hi=None) -> DataFrame:
        """The collection as of the newest manifest, between two times: [lo, hi).
        Rows without a time are part of it only without a range."""
        m = self.manifest()
        schema = T.StructType.fromJson(json.loads(m.schema)) if m.schema else T.StructType([T.StructField(self.ts, T.TimestampType())])
        return self._read(m, list(m.entries), schema, lo, hi).drop(DAY, ENTRY)

    def _read(self, m: Manifest, entries: list[str], schema: T.StructType, lo=None, hi=None) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], schema.add(ENTRY, "string").add(DAY, "date"))
        base = f"{self.path}/data"
        whole = T.StructType([*schema.fields, T.StructField(ENTRY, T.StringType()), T.StructField(DAY, T.DateType())])
        df = self.spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{ENTRY}={e}" for e in entries])
        if lo is not None:
            df = df.where(F.col(DAY) >= F.to_date(F.lit(lo)))
        if hi is not None:
            df = df.where(F.col(DAY) <= F.to_date(F.lit(hi)))
        return time_filter(df, lo, hi, self.ts)

    # -- upkeep ------------------------------------------------------------

    def compact(self, fewest: int = 2) -> int:
        """Rewrite all entries as one if there are ``fewest`` or more; the number
        of entries taken in.  A day's rows are cut into files by time, each
        sorted, so that a time range skips files and row groups."""
        m = self.manifest()
        if len(m.entries) < fewest:
            return 0
        old = list(m.entries)
        schema = T.StructType.fromJson(json.loads(m.schema))
        rows = self._read(m, old, schema).drop(ENTRY)
        n = max(1, -(-rows.count() // FILE_ROWS))
        entry = uuid.uuid4().hex
        rows.repartitionByRange(n, DAY, self.ts).sortWithinPartitions(DAY, self.ts).write.partitionBy(DAY).parquet(f"{self.path}/data/{ENTRY}={entry}")

        def change(now: Manifest):
            if any(now.entries.get(e) != m.entries[e] for e in old):
                raise CommitConflict(f"entries of {self.path} changed while they were compacted")
            rest = {e: b for e, b in now.entries.items() if e not in m.entries}
            return {entry: sorted(b for e in old for b in m.entries[e]), **rest}, now.schema

        self._commit(change)
        return len(old)

    def vacuum(self) -> int:
        """Remove entries that the newest manifest does not name.  Run it where
        no writer is at work and no reader uses an older manifest."""
        named = {f"{ENTRY}={e}" for e in self.manifest().entries}
        dead = [n for n in self._children("data") if n not in named]
        for n in dead:
            self._fs.delete(self._at(f"data/{n}"), True)
        return len(dead)
