"""Suffix-array dedup: removal of byte strings that occur elsewhere.

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else in the corpus.

1. *Groups that can match.*  Each window of ``length`` bytes names as anchor
   its k-gram of smallest hash, a choice that depends on its bytes alone: equal
   windows have equal anchors at equal offsets.  Neighbouring windows with one
   anchor form a fragment.  Fragments whose anchor occurs once are unique and
   go no further; equal fragments of an anchor count once, with a multiplicity.
2. *Two-stage suffix sorting* of the fragments of whole anchor groups: suffixes
   smaller than their successor are sorted directly, the others are induced by
   scanning the buckets of first bytes in order.  Adjacent common prefixes of
   the sorted windows show which windows occur twice.
3. Repeated windows go back to every occurrence of their fragment, and each
   text is cut.

A group with too many different fragments for one task (the edges of a passage
that a third of all texts hold) is split by a longer key, ``_BLOCKS``: blocks of
neighbouring windows at one offset from the anchor are grouped by the bytes
that all of the block's windows share, at last single windows by themselves.
Equal windows stay in one group at every level, so nothing is lost.

Defined results.  A null text is empty and has nothing to remove; texts shorter
than ``length`` cannot match.  Rows that repeat match each other, so that both
lose their bytes.  A null doc_id is carried as null.  Other columns are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.shared import byte_table, mix, prefix_sums, slice_hash, slices, staged, string_buffers

LENGTH, GRAM = 400, 48
#: Windows in a block at each level of splitting after whole fragments.
_BLOCKS = (16, 1)
#: More different fragments than this in one group are split further.
MOST_FRAGMENTS = 2_000
_ONE, _TWO = byte_table(41), byte_table(43)


# -- step 1: fragments -------------------------------------------------------

def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block prefixes and suffixes."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    grid = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(values)] = values
    grid = grid.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def fragments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Fragments of concatenated texts: first and last window start, anchor
    position, anchor hash."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    n = len(data)
    if n < length:
        return empty
    step, place = 1 << 21, np.uint64((1 << 24) - 1)
    found = []
    for lo in range(0, n - length + 1, step):
        part = data[lo : lo + step + length - 1]
        sums = prefix_sums(part, _ONE)
        at = np.arange(len(part) - gram + 1)
        h = slice_hash(sums, at, at + gram)
        least = sliding_min((h & ~place) | at.astype(np.uint64), length - gram + 1)
        start = np.arange(lo, lo + len(least))
        # windows that end within the text they start in
        text = np.searchsorted(offsets, start, side="right")
        inside = np.flatnonzero(start + length <= offsets[np.minimum(text, len(offsets) - 1)])
        if not len(inside):
            continue
        least = least[inside]
        first = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(inside) != 1))))
        last = np.concatenate((first[1:], [len(inside)])) - 1
        anchor = (least[first] & place).astype(np.int64)
        found.append((inside[first] + lo, inside[last] + lo, anchor + lo, h[anchor]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else empty


def _double_hash(data: np.ndarray) -> tuple:
    one, two = prefix_sums(data, _ONE), prefix_sums(data, _TWO)

    def of(starts: np.ndarray, ends: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = mix(salt.astype(np.int64).view(np.uint64))
        return (slice_hash(one, starts, ends) ^ s).view(np.int64), (slice_hash(two, starts, ends) + s).view(np.int64)

    return of


_OCCURRENCE = "id long, row long, key long, f1 long, f2 long, start long, anchor long, windows int"


def _emit(ids, rows, key, f1, f2, start, anchor, windows) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(c, np.int64)) for c in (ids, rows, key, f1, f2, start, anchor)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(np.asarray(windows, np.int32))], names=["id", "row", "key", "f1", "f2", "start", "anchor", "windows"])


def _anchored(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            data, off = string_buffers(b.column("text"))
            s, e, a, h = fragments(data, off, length, gram)
            if not len(s):
                continue
            f1, f2 = _double_hash(data)(s, e + length, a - s)
            doc = np.searchsorted(off, s, side="right") - 1
            ids, rows = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "row"))
            yield _emit(ids[doc], rows[doc], h.view(np.int64), f1, f2, s - off[doc], a - off[doc], e - s + 1)

    return run


_PIECE = "key long, f1 long, f2 long, copies long, lead long, bytes binary"
_PIECE_TYPES = [("key", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("copies", pa.int64()), ("lead", pa.int64()), ("bytes", pa.binary())]


def _blocks(length: int, size: int):
    """Pieces of fragments: blocks of ``size`` windows at fixed offsets from the
    anchor, keyed by the bytes common to a whole block, with the fragment they
    are from (k0, g1, g2) and the window ``at`` which they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "bytes"):
            raw, off = string_buffers(b.column("bytes"))
            key, g1, g2, copies, lead = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "f1", "f2", "copies", "lead"))
            windows = np.diff(off) - length + 1
            lo_block, hi_block = -lead // size, (windows - 1 - lead) // size
            count = hi_block - lo_block + 1
            of = np.repeat(np.arange(len(key)), count)
            block = lo_block[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            x = np.maximum(-lead[of], block * size)  # windows as offsets from the anchor
            y = np.minimum((windows - lead)[of], (block + 1) * size)
            anchor = off[of] + lead[of]
            double = _double_hash(raw)
            # a block at the edge of its fragment may lack a part of the common
            # bytes' place, but all its windows hold them
            k1, _ = double(anchor + block * size + size - 1, anchor + block * size + length, key[of] ^ block)
            f1, f2 = double(anchor + x, anchor + y - 1 + length, x)
            data = raw.tobytes()
            at = (anchor + x).tolist()
            cut = [data[p : p + n] for p, n in zip(at, (y - x - 1 + length).tolist())]
            longs = [k1, f1, f2, copies[of], -x, key[of], g1[of], g2[of], x + lead[of]]
            arrays = [pa.array(np.asarray(c, np.int64)) for c in longs]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(cut, pa.binary())], names=["key", "f1", "f2", "copies", "lead", "k0", "g1", "g2", "at", "bytes"])

    return run


# -- step 2: two-stage suffix sorting ----------------------------------------

def rising(data: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor.  Equal bytes take
    the answer of what follows; the last suffix is greater than the empty one."""
    n = len(data)
    out = np.zeros(n, bool)
    differs = np.flatnonzero(data[1:] != data[:-1])
    if len(differs):
        nxt = np.searchsorted(differs, np.arange(n))
        has = nxt < len(differs)
        d = differs[np.minimum(nxt, len(differs) - 1)]
        out[has] = (data[d] < data[d + 1])[has]
    return out


def two_stage_sort(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, exact to ``depth``."""
    n = len(data)
    up = rising(data)
    # wanted suffixes and those that lead to them: up to the next rising one
    ups = np.flatnonzero(up)
    follow = np.searchsorted(ups, wanted)
    until = np.where(follow < len(ups), ups[np.minimum(follow, max(len(ups) - 1, 0))], n - 1) if len(ups) else np.full(len(wanted), n - 1)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, wanted, 1)
    np.add.at(marks, until + 1, -1)
    need = np.cumsum(marks[:n]) > 0
    raw = data.tobytes()
    direct = np.flatnonzero(need & up)
    keys = [raw[i : i + depth] for i in direct.tolist()]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    by_byte = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def scan(entries: np.ndarray, here: int) -> np.ndarray:
        """Put the greater predecessors of sorted entries into their buckets;
        those of the bucket being scanned are returned as its next entries."""
        before = entries[entries > 0] - 1
        before = before[need[before] & ~up[before]]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte.astype(np.int16), prepend=-1, append=-1))
        more = np.zeros(0, np.int64)
        for x, y in zip(cuts, cuts[1:]):
            if byte[x] == here:
                more = before[x:y]
            else:
                induced[byte[x]].append(before[x:y])
        return more

    scan(np.array([n]), -1)
    out = []
    for c in range(256):
        wave = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = scan(wave, c)
        bucket = direct[by_byte[c] : by_byte[c + 1]]
        if len(bucket):
            out.append(bucket)
            scan(bucket, c)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    chosen = np.zeros(n, bool)
    chosen[wanted] = True
    return order[chosen[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most``, of each suffix with the one
    before it in ``order`` (all have ``most`` bytes left): bisection on hashes,
    full lengths confirmed byte by byte."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    sums = prefix_sums(data, _ONE)
    a, b = order[:-1], order[1:]
    # most neighbours agree fully or not: the bisection is for the others
    low = np.where(slice_hash(sums, a, a + most) == slice_hash(sums, b, b + most), most, 0)
    open_ = np.flatnonzero(low == 0)
    lo, hi = np.zeros(len(open_), np.int64), np.full(len(open_), most)
    x, y = a[open_], b[open_]
    while len(lo) and (hi - lo > 1).any():
        mid = (lo + hi) // 2
        same = slice_hash(sums, x, x + mid) == slice_hash(sums, y, y + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid)
    low[open_] = lo
    raw = data.tobytes()
    for i in np.flatnonzero(low == most).tolist():
        if raw[a[i] : a[i] + most] != raw[b[i] : b[i] + most]:
            low[i] = most - 1
    return np.concatenate(([0], low))


def repeated_windows(texts: list[bytes], copies: np.ndarray, length: int) -> list[np.ndarray]:
    """For each fragment the window starts that occur more than once among all
    fragments; those with several copies occur again in their copies."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    windows = sizes - length + 1
    wanted = np.repeat(begin, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    order = two_stage_sort(data, wanted, length)
    same = common_prefixes(data, order, length) >= length
    twice = np.zeros(len(data), bool)
    twice[order[same]] = True
    twice[order[np.flatnonzero(same) - 1]] = True
    for i in np.flatnonzero(copies > 1):
        twice[begin[i] : begin[i] + windows[i]] = True
    return [np.flatnonzero(twice[x : x + w]) for x, w in zip(begin.tolist(), windows.tolist())]


_REPEATS = "key long, f1 long, f2 long, runs array<struct<lo:int,hi:int>>"


def _sorter(length: int, most: int = 400_000):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([r[4] for r in rows], np.array([r[3] for r in rows]), length)
        out = []
        for r, w in zip(rows, found):
            if len(w):
                cut = np.flatnonzero(np.diff(w) != 1)
                lo, hi = w[np.concatenate(([0], cut + 1))], w[np.concatenate((cut, [len(w) - 1]))]
                out.append((r[0], r[1], r[2], [{"lo": x, "hi": y} for x, y in zip(lo.tolist(), hi.tolist())]))
        cols = list(zip(*out)) if out else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "f1", "f2", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key: whole groups are gathered and sorted together."""
        rows, size, seen = [], 0, set()
        for b in slices(batches, "bytes"):
            for r in zip(*(b.column(c).to_pylist() for c in ("key", "f1", "f2", "copies", "bytes"))):
                if rows and r[0] != rows[-1][0] and size >= most:
                    yield solve(rows)
                    rows, size = [], 0
                if not rows or r[0] != rows[-1][0]:
                    seen = set()
                if (r[1], r[2]) not in seen:  # a repeated row has sent it twice
                    seen.add((r[1], r[2]))
                    rows.append(r)
                    size += len(r[4])
        if rows:
            yield solve(rows)

    return run


# -- step 3 and the whole ----------------------------------------------------

def _extract(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = []
            for text, parts in zip(b.column("text").to_pylist(), b.column("parts").to_pylist()):
                raw = text.encode("utf-8")
                for p in parts:
                    out.append((p["key"], p["f1"], p["f2"], p["copies"], p["anchor"] - p["start"], raw[p["start"] : p["start"] + p["windows"] - 1 + length]))
            cols = list(zip(*out)) if out else [[] for _ in _PIECE_TYPES]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _PIECE_TYPES)], names=[n for n, _ in _PIECE_TYPES])

    return run


def _repeats(pieces: DataFrame, length: int, most: int, blocks: tuple[int, ...]) -> DataFrame:
    """key, f1, f2, runs of repeated windows, of different pieces."""
    groups = pieces.groupBy("key").agg(F.sum("copies").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    groups = staged(groups.select("key", (F.col("kinds") > most).alias("large") if blocks else F.lit(False).alias("large")), "repeat-groups")
    fit = pieces.join(groups.where("not large").select("key"), "key", "left_semi")
    found = fit.repartition("key").sortWithinPartitions("key").mapInArrow(_sorter(length), _REPEATS)
    if not groups.where("large").limit(1).count():
        return found
    large = pieces.join(groups.where("large").select("key"), "key", "left_semi")
    cut = staged(large.mapInArrow(_blocks(length, blocks[0]), "key long, f1 long, f2 long, copies long, lead long, k0 long, g1 long, g2 long, at long, bytes binary"), "repeat-blocks")
    distinct = cut.groupBy("key", "f1", "f2").agg(F.sum("copies").alias("copies"), F.min("lead").alias("lead"), F.min("bytes").alias("bytes"))
    below = _repeats(staged(distinct, "repeat-pieces"), length, most, blocks[1:])
    back = cut.drop("bytes").join(below, ["key", "f1", "f2"]).select(
        F.col("k0").alias("key"), F.col("g1").alias("f1"), F.col("g2").alias("f2"),
        F.transform("runs", lambda r: F.struct((r["lo"] + F.col("at")).cast("int").alias("lo"), (r["hi"] + F.col("at")).cast("int").alias("hi"))).alias("runs"),
    )
    return found.unionByName(back.groupBy("key", "f1", "f2").agg(F.flatten(F.collect_list("runs")).alias("runs")))


def _cutter(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = []
            for doc, text, spans in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("spans").to_pylist()):
                raw = text.encode("utf-8")
                merged: list[list[int]] = []
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                at, kept = 0, []
                for lo, hi in merged:
                    kept.append(raw[at:lo])
                    at = hi
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((doc, len(raw), sum(h - x for x, h in merged), len(merged), rest if with_text else hashlib.sha256(rest).hexdigest()))
            cols = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary() if with_text else pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", name])

    name = "kept" if with_text else "kept_sha256"
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_fragments: int = MOST_FRAGMENTS, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the bytes
    that stay, ``kept`` (with ``digest``: ``kept_sha256``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    texts = docs.select(F.coalesce(doc, F.lit(0).cast("long")).alias("id"), F.xxhash64(doc.isNull(), text).alias("row"), doc.alias("doc_id"), text.alias("text"))
    long = texts.where(F.octet_length("text") >= length).select("id", "row", "text")
    occurrences = staged(long.mapInArrow(_anchored(length, gram), _OCCURRENCE), "fragments")
    distinct = staged(
        occurrences.groupBy("key", "f1", "f2")
        .agg(F.count("*").alias("copies"), F.min(F.struct("id", "row", "start", "windows", "anchor")).alias("at")),
        "fragment-counts",
    )
    again = distinct.groupBy("key").agg(F.sum("copies").alias("all")).where("all > 1").select("key")
    parts = distinct.join(again, "key", "left_semi").groupBy("at.id", "at.row").agg(F.collect_list(F.struct("key", "f1", "f2", "copies", "at.start", "at.windows", "at.anchor")).alias("parts"))
    # rows that repeat (id, row) count in copies only: one text sends its pieces
    pieces = staged(long.dropDuplicates(["id", "row"]).join(parts, ["id", "row"]).mapInArrow(_extract(length), _PIECE), "pieces")
    repeats = staged(_repeats(pieces, length, most_fragments, _BLOCKS), "repeats")
    spans = occurrences.join(repeats, ["key", "f1", "f2"]).select(
        "id", "row", F.transform("runs", lambda r: F.struct((F.col("start") + r["lo"]).alias("lo"), (F.col("start") + r["hi"] + length).alias("hi"))).alias("spans")
    )
    # and one set of spans: those of a fragment are equal in each of them
    spans = spans.groupBy("id", "row").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    last = "kept_sha256 string" if digest else "kept binary"
    return texts.join(spans, ["id", "row"], "left").mapInArrow(_cutter(length, not digest), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
