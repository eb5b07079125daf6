"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts become arrays of codepoint classes.  Each class is a transition function
of a small automaton; composing such functions is associative, so the state
before every character comes from a scan over function codes (a lookup table
of compositions), and with it the boundaries of the pieces: no regular
expression runs over the text.  The slices between boundaries feed pair
merging, which works on all new pieces of a batch at once and keeps their ids
in a bounded cache.  Byte offsets of the tokens are kept, so that decoding is
a gather.

Defined results.  A null text is empty and has no tokens.  Texts of any length
are taken whole.  Every row is encoded by itself, repeated or not; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitwall.llm.shared import SliceTable, byte_table, mix, prefix_sums, slice_hash, slices, string_buffers, take_ranges

# -- codepoint classes -------------------------------------------------------

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Symbols of the automaton: classes, refined by what follows.
SYM_LETTER, SYM_NUMBER, SYM_OTHER, SYM_SPACE, SYM_LAST_BLANK, SYM_LAST_SPACE, SYM_APOSTROPHE_1, SYM_APOSTROPHE_2 = range(8)
#: States: nothing open (start, or after a contraction), an open run of each
#: class, a blank that joins the next run, one or two letters left of a contraction.
(AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, JOINING, LEFT_1, LEFT_2) = range(8)

#: White space of the pattern's \s (fixed values, as Unicode lists them).
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(None)
def class_table() -> np.ndarray:
    """Class of every code point, from Unicode's general categories."""
    kinds = "".join(map(unicodedata.category, map(chr, range(0x110000))))[::2]
    first = np.frombuffer(kinds.encode(), np.uint8)
    table = np.full(0x110000, OTHER, np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[WHITE] = SPACE
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at this character."""
    if state == LEFT_2:
        return LEFT_1, False
    if state == LEFT_1:
        return AT_START, False
    if symbol in (SYM_APOSTROPHE_1, SYM_APOSTROPHE_2) and state not in (IN_OTHERS, JOINING):
        return (LEFT_1 if symbol == SYM_APOSTROPHE_1 else LEFT_2), True
    if symbol in (SYM_OTHER, SYM_APOSTROPHE_1, SYM_APOSTROPHE_2):
        return IN_OTHERS, state not in (IN_OTHERS, JOINING)
    if symbol == SYM_LETTER:
        return IN_LETTERS, state not in (IN_LETTERS, JOINING)
    if symbol == SYM_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if symbol == SYM_SPACE:
        return IN_SPACES, state != IN_SPACES
    # the last blank before a non-blank is a piece of its own, or joins the next
    return (JOINING if symbol == SYM_LAST_BLANK else AT_START), True


@lru_cache(None)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function code of each symbol, the table that composes two codes (first,
    then), each code's value at the start state, and starts[state, symbol]."""
    functions = [tuple(_step(s, y)[0] for s in range(8)) for y in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys(functions))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in list(known):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
    codes = list(known)
    table = np.array([[known[tuple(g[x] for x in f)] for g in codes] for f in codes], np.uint16)
    at_start = np.array([f[AT_START] for f in codes], np.uint8)
    starts = np.array([[_step(s, y)[1] for y in range(8)] for s in range(8)], bool)
    return np.array([known[f] for f in functions], np.uint16), table, at_start, starts


def scan(codes: np.ndarray, table: np.ndarray, width: int = 256) -> np.ndarray:
    """Inclusive scan of function composition: blocks side by side, then the
    carries of the blocks by the same scan."""
    n = len(codes)
    if n <= width:
        out = np.empty(n, np.uint16)
        acc = None
        for i in range(n):
            acc = codes[i] if acc is None else table[acc, codes[i]]
            out[i] = acc
        return out
    rows = -(-n // width)
    grid = np.zeros((width, rows), np.uint16)
    padded = np.full(rows * width, codes[-1], np.uint16)
    padded[:n] = codes
    grid[:] = padded.reshape(rows, width).T
    for j in range(1, width):
        grid[j] = table[grid[j - 1], grid[j]]
    carry = scan(grid[-1], table, width)
    grid[:, 1:] = table[carry[None, :-1], grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


def symbols(points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``last`` marks the last one of each text."""
    kind = class_table()[points]
    out = kind.copy()  # letter, number, other and space keep their number
    n = len(points)
    nxt = np.concatenate((kind[1:], [SPACE]))
    ends_blank = (kind == SPACE) & (nxt != SPACE) & ~last
    out[ends_blank] = SYM_LAST_SPACE
    out[ends_blank & (points == 32)] = SYM_LAST_BLANK
    mark = np.flatnonzero((points == 39) & ~last)
    if len(mark):
        one = points[np.minimum(mark + 1, n - 1)]
        two = np.where(last[np.minimum(mark + 1, n - 1)], 0, points[np.minimum(mark + 2, n - 1)])
        out[mark[np.isin(one, [ord(c) for c in "stmd"])]] = SYM_APOSTROPHE_1
        for a, b in ("re", "ve", "ll"):
            out[mark[(one == ord(a)) & (two == ord(b))]] = SYM_APOSTROPHE_2
    return out


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions where pieces start; ``text_starts`` are those of non-empty texts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    codes_of, table, at_start, starts = automaton()
    last = np.zeros(n, bool)
    last[text_starts[1:] - 1] = True
    last[-1] = True
    sym = symbols(points, last)
    state = np.empty(n, np.uint8)
    state[0] = AT_START
    state[1:] = at_start[scan(codes_of[sym], table)[:-1]]
    # A text starts anew.  Its first state matters only up to its first few
    # characters, and a scan would carry the text before into it: restart there.
    reset = _resets(sym, text_starts, state)
    return np.flatnonzero(starts[reset, sym])


def _resets(sym: np.ndarray, text_starts: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Correct the states at the start of each text, step by step while they
    differ from the scanned ones, for all texts at once."""
    at = text_starts[1:]
    want = np.full(len(at), AT_START, np.uint8)
    step = np.array([[_step(s, y)[0] for y in range(8)] for s in range(8)], np.uint8)
    limit = np.concatenate((text_starts[2:], [len(sym)])) if len(at) else at
    while len(at):
        off = state[at] != want
        at, want, limit = at[off], want[off], limit[off]
        state[at] = want
        want = step[want, sym[at]]
        at = at + 1
        inside = at < limit
        at, want, limit = at[inside], want[inside], limit[inside]
    return state


# -- ranks and merging -------------------------------------------------------


class Merger:
    """Ids of pieces by lowest-rank pair merging."""

    LONG = 48

    def __init__(self, path: str, most: int = 1_000_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_sizes = np.array([len(t) for t in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.pairs = dict(zip(keys, values))
        self._build(np.array(keys, np.uint64), np.array(values, np.int32))
        self.table = byte_table(7)
        self.cache = SliceTable(most)
        self._clear()

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open-addressing table of pair -> rank for vectorised lookups."""
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.mask = np.uint64((1 << bits) - 1)
        self.slot_key = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.slot_value = np.full(1 << bits, np.iinfo(np.int32).max, np.int32)
        at, left, self.probes = mix(keys) & self.mask, np.arange(len(keys)), 0
        while len(left):
            self.probes += 1
            free = self.slot_key[at[left]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.slot_key[at[put]], self.slot_value[at[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + np.uint64(1)) & self.mask

    def _clear(self) -> None:
        """An empty cache holds the vocabulary: a piece that is a token is it."""
        self.cache.clear()
        known = np.flatnonzero(self.token_sizes > 0)
        sums = prefix_sums(self.token_bytes, self.table)
        lo = self.token_starts[known]
        self.cache.add(slice_hash(sums, lo, lo + self.token_sizes[known]))
        self.starts, self.sizes = np.zeros(self.cache.most + 1, np.int64), np.zeros(self.cache.most + 1, np.int64)
        self.starts[: len(known)], self.sizes[: len(known)] = np.arange(len(known)), 1
        self.flat, self.used = np.zeros(1 << 20, np.int32), len(known)
        self.flat[: len(known)] = known

    def _store(self, entries: np.ndarray, ids: np.ndarray) -> None:
        """Keep the rows of ``ids`` as the ids of these cache entries."""
        n, width = ids.shape
        while self.used + n * width > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(len(self.flat), np.int32)))
        self.starts[entries], self.sizes[entries] = self.used + np.arange(n) * width, width
        self.flat[self.used : self.used + n * width] = ids.ravel()
        self.used += n * width

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; the largest int32 where they don't merge."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = mix(key) & self.mask
        out = np.full(len(key), np.iinfo(np.int32).max, np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            slot = at[open_]
            held = self.slot_key[slot]
            hit = held == key[open_]
            out[open_[hit]] = self.slot_value[slot[hit]]
            open_ = open_[~hit & (held != np.uint64(0xFFFFFFFFFFFFFFFF))]
            if not len(open_):
                break
            at[open_] = (at[open_] + np.uint64(1)) & self.mask
        return out

    def merge_rows(self, entries: np.ndarray, ids: np.ndarray) -> None:
        """Merge pieces of one length side by side: ``ids`` starts as their
        byte ids, one row each; in every step each row merges its best pair."""
        top = np.iinfo(np.int32).max
        width = ids.shape[1]
        if width == 1:
            self._store(entries, ids)
            return
        rank = self.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width - 1)
        while True:
            width = ids.shape[1]
            every = np.arange(len(ids))
            best = rank.argmin(axis=1)
            low = rank[every, best]
            done = low == top
            if done.any():
                self._store(entries[done], ids[done])
                open_ = ~done
                entries, ids, rank, best, low = entries[open_], ids[open_], rank[open_], best[open_], low[open_]
                every = np.arange(len(ids))
            if not len(ids):
                return
            ids[every, best] = low
            keep = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            ids = np.take_along_axis(ids, keep, 1)
            if width == 2:
                self._store(entries, ids)
                return
            rank = np.take_along_axis(rank, keep[:, : width - 2] + (keep[:, : width - 2] == best[:, None]), 1)
            left = np.flatnonzero(best > 0)
            rank[left, best[left] - 1] = self.rank_of(ids[left, best[left] - 1], ids[left, best[left]])
            right = np.flatnonzero(best < width - 2)
            rank[right, best[right]] = self.rank_of(ids[right, best[right]], ids[right, best[right] + 1])

    def merge_one(self, piece: bytes) -> np.ndarray:
        """Merge a long piece by a heap of pairs over linked neighbours."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = self.pairs.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                heap.append((r, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (s := self.pairs.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], np.int64)

    def learn(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> None:
        """Merge the slices, all different and new, and cache their ids."""
        entries = self.cache.add(hashes)
        long = sizes > self.LONG
        order = np.argsort(sizes[~long], kind="stable")
        lo, n, e = starts[~long][order], sizes[~long][order], entries[~long][order]
        cuts = np.flatnonzero(np.diff(n, prepend=-1, append=-1))
        for x, y in zip(cuts, cuts[1:]):
            at = lo[x:y, None] + np.arange(n[x])[None, :]
            self.merge_rows(e[x:y], self.byte_ids[data[at]])
        for i in np.flatnonzero(long):
            got = self.merge_one(data[starts[i] : starts[i] + sizes[i]].tobytes())
            self._store(entries[i : i + 1], got[None, :])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, and the offsets of each text's ids."""
        data, offsets = string_buffers(column)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        filled = offsets[:-1][np.diff(offsets) > 0]
        starts = place[piece_starts(points, np.searchsorted(place, filled))]
        ends = np.concatenate((starts[1:], [len(data)]))
        hashes = slice_hash(prefix_sums(data, self.table), starts, ends)
        at = self.cache.find(hashes)
        if (missing := np.flatnonzero(at < 0)).size:
            new, first = np.unique(hashes[missing], return_index=True)
            if self.cache.count + len(new) > self.cache.most:
                self._clear()
                at = self.cache.find(hashes)
                missing = np.flatnonzero(at < 0)
                new, first = np.unique(hashes[missing], return_index=True)
                if self.cache.count + len(new) > self.cache.most:
                    self.cache = SliceTable(2 * (self.cache.count + len(new)))
                    self._clear()
            one = missing[first]
            self.learn(data, starts[one], ends[one] - starts[one], new)
            at[missing] = self.cache.find(hashes[missing])
        counts = self.sizes[at]
        ids = self.flat[take_ranges(self.starts[at], counts)].astype(np.int64)
        upto = np.concatenate(([0], np.cumsum(counts)))
        return ids, upto[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, and the byte offset of each token (one more)."""
        sizes = self.token_sizes[ids]
        return self.token_bytes[take_ranges(self.token_starts[ids], sizes)], np.concatenate(([0], np.cumsum(sizes)))


@lru_cache(2)
def merger_of(path: str) -> Merger:
    """One for all tasks of a worker process: they share what it has learnt."""
    return Merger(path)


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and byte offsets
    of the tokens (likewise); with ``digests`` the SHA-256 of the ids and of
    the bytes decoded from them instead, so that no ids leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = merger_of(ranks)
        for b in slices(batches, text_col, 4 << 20):
            ids, off = merger.encode(b.column(text_col))
            raw, places = merger.decode(ids)
            coded = ids.astype("<u4").view(np.uint8)
            bounds = off.tolist()
            byte_at = places[off].tolist()
            cols: list = [b.column(id_col).cast(pa.int64()), pa.array(np.diff(off), pa.int64())]
            spans = list(zip(bounds, bounds[1:]))
            if digests:
                cols.append(pa.array([hashlib.sha256(coded[4 * x : 4 * y]).hexdigest() for x, y in spans], pa.string()))
                cols.append(pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(byte_at, byte_at[1:])], pa.string()))
            else:
                cols.append(pa.array([coded[4 * x : 4 * y].tobytes() for x, y in spans], pa.binary()))
                cols.append(pa.array([(places[x:y] - z).astype("<u4").tobytes() for (x, y), z in zip(spans, byte_at)], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "offsets"))]
    kind = "string" if digests else "binary"
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id long, n_tokens long, {names[2]} {kind}, {names[3]} {kind}")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id and text of what ``encode`` returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = merger_of(ranks)
        for b in slices(batches, "ids"):
            texts = []
            for x in b.column("ids").to_pylist():
                texts.append(merger.decode(np.frombuffer(x or b"", "<u4").astype(np.int64))[0].tobytes().decode("utf-8"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
