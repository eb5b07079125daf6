"""Helpers of the subpackage: staging in the shared folder, Arrow text access,
vectorised hashing of byte slices."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.config import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder below ``spark.checkpoint.dir``
    and read it back: later steps then neither repeat its work nor depend on
    files of a single executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a staged table that may be sent to every task (under 50 MB as used).
FEW_ROWS = 200_000


def sent_if_few(df: DataFrame) -> DataFrame:
    """A staged table of keys, to be broadcast where it has few rows, so that a
    join moves none of the texts on its other side; it is counted first, since
    the size of a plan says little.  Larger ones are left to a shuffle join."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that starts with ``base`` and clashes with none of ``df``."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id) -> F.Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


# -- Arrow -----------------------------------------------------------------

def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null is empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    col = pc.fill_null(column.cast(kind), pa.scalar(b"" if kind == pa.large_binary() else "", kind))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of ``column``
    (one row at least): memory of a task follows this, not the batch size."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        lo = 0
        while lo < n:
            base = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def give_back() -> None:
    """What this process has freed goes back to the system (as far as the C
    library can do that)."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, which gives its memory back when a task ends:
    its worker process lives on, for tasks that need theirs beside it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


_KEPT: dict = {}


def kept(key: tuple, make: Callable):
    """What ``make`` builds, kept in this worker process for later tasks with the
    same key.  Only the last key's is: a worker outlives the operators it served,
    and what one kept would lie beside what the next one needs."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def take_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), concatenated."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)


# -- hashing ---------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, 1 << 20), base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (a bijection of 64-bit words)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64((seed * 1000003 + 1) * 256))


def prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of table[byte] * base**position, for hashes of any slice."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices [start, end); equal bytes give equal hashes."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


# -- words -----------------------------------------------------------------

_IS_WORD = np.zeros(256, bool)
_IS_WORD[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _IS_WORD[_c] = True


def runs_inside(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True within texts: starts, ends, and for each text the
    index of its first run (one more entry than texts)."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated UTF-8 texts, as ``runs_inside`` gives them.  A word
    is a maximal run of ASCII letters and digits or non-ASCII characters."""
    return runs_inside(_IS_WORD[data], offsets)


class SliceTable:
    """Open-addressing table from 64-bit hashes to entry numbers 0, 1, 2, ...
    whose lookups and insertions run over whole arrays."""

    def __init__(self, most: int):
        bits = max(8, int(most * 2 - 1).bit_length())
        self.most, self.mask = most, np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.entry = np.full(1 << bits, -1, np.int32)
        self.count = 0

    def clear(self) -> None:
        self.keys.fill(0)
        self.entry.fill(-1)
        self.count = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry number of each hash, or -1."""
        at = hashes & self.mask
        out = self.entry[at]
        left = np.flatnonzero((self.keys[at] != hashes) & (out >= 0))
        while len(left):
            at[left] = (at[left] + np.uint64(1)) & self.mask
            slot = at[left]
            out[left] = self.entry[slot]
            left = left[(self.keys[slot] != hashes[left]) & (out[left] >= 0)]
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Insert distinct new hashes; their entry numbers."""
        numbers = np.arange(self.count, self.count + len(hashes), dtype=np.int32)
        self.count += len(hashes)
        at, left = hashes & self.mask, np.arange(len(hashes))
        while len(left):
            slot = at[left]
            free = left[self.entry[slot] < 0]
            self.entry[at[free]] = numbers[free]
            won = free[self.entry[at[free]] == numbers[free]]
            self.keys[at[won]] = hashes[won]
            rest = np.ones(len(hashes), bool)
            rest[won] = False
            left = left[rest[left]]
            at[left] = (at[left] + np.uint64(1)) & self.mask
        return numbers
