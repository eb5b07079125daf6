"""Packing: Karmarkar-Karp multiway differencing.

Every document becomes the ids of its text and one end id.  What exceeds the
window is cut into full windows; the remainders are packed in batches of about
``batch`` windows.  Within a batch each remainder starts as a partial partition
(one window of that length, the rest empty); the two partitions of largest
imbalance merge again and again, the fullest windows of one with the emptiest
of the other, until one partition is left: near-equal windows.  If its fullest
window exceeds the capacity, the count of windows rises and the batch is
packed again.  Batches close when they fill ``batch`` windows all but a slack
for the imbalance; the document on the edge is cut there.

Each task packs what it reads: nothing is shuffled, and memory is one batch.

Defined results.  A null text is empty: such a document is its end id alone.
A text of any length is taken whole.  Rows that repeat are packed as separate
documents.  An empty table gives no pieces.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pitwall.llm.shared import SliceTable, byte_table, giving_back, kept, prefix_sums, runs_inside, slice_hash, slices, string_buffers, take_ranges

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


#: Bytes of texts encoded at once, and lines of new words given to the tokenizer
#: at once: a worker's memory follows them.
PIECE, LINES = 1 << 19, 10

#: A character that is a word of one id wherever it stands between blanks.
MARK = "\x01"


def word_ids(path: str, end_id: int) -> WordIds:
    """One for all tasks of a worker process: they share what it has learnt."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return kept(("packing", path, end_id), lambda: WordIds(path, end_id))


class WordIds:
    """Ids of texts by a tokenizer that drops white space: encodes each
    distinct blank-free chunk once while it stays in a bounded cache."""

    def __init__(self, path: str, end_id: int, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.table = end_id, byte_table(11)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self._clear(most)

    def _clear(self, most: int) -> None:
        self.cache = SliceTable(most)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Encode new words, many in one text: a mark of one id stands between
        them.  Words that hold the mark's character are encoded by themselves."""
        raw = data.tobytes()
        words = [raw[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
        marked = np.array([MARK in w for w in words])
        sizes, flat = np.zeros(len(words), np.int64), []
        plain = np.flatnonzero(~marked)
        lines, alone = [plain[lo : lo + 200] for lo in range(0, len(plain), 200)], np.flatnonzero(marked)
        for lo in range(0, len(lines), LINES):
            part = lines[lo : lo + LINES]
            for at, got in zip(part, self.tokenizer.encode_batch_fast([f" {MARK} ".join(words[i] for i in line) for line in part], add_special_tokens=False)):
                ids = np.array(got.ids, np.uint32)
                cuts = np.flatnonzero(ids == self.mark)
                sizes[at] = np.diff(cuts, prepend=-1, append=len(ids)) - 1
                flat.append(ids[ids != self.mark])
        for i in alone:
            ids = np.array(self.tokenizer.encode(words[i], add_special_tokens=False).ids, np.uint32)
            sizes[i] = len(ids)
            flat.append(ids)
        order = np.concatenate((plain, alone))
        self.cache.add(hashes[order])
        sizes = sizes[order]
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate([self.flat, *flat])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        data, offsets = string_buffers(column)
        starts, ends, first = runs_inside((data != 32) & (data != 10), offsets)
        if len(starts):
            hashes = slice_hash(prefix_sums(data, self.table), starts, ends)
            at = self.cache.find(hashes)
            if (missing := np.flatnonzero(at < 0)).size:
                new, one = np.unique(hashes[missing], return_index=True)
                if self.cache.count + len(new) > self.cache.most:
                    new, one = np.unique(hashes, return_index=True)
                    missing = np.arange(len(hashes))
                    self._clear(max(self.cache.most, 2 * len(new)))
                self._learn(data, starts[missing[one]], ends[missing[one]], new)
                at[missing] = self.cache.find(hashes[missing])
            sizes = self.sizes[at]
            ids = self.flat[take_ranges(self.starts[at], sizes)]
            bounds = np.concatenate(([0], np.cumsum(sizes)))[first].tolist()
        else:
            ids, bounds = np.zeros(0, np.uint32), [0] * len(offsets)
        end = np.array([self.end_id], np.uint32)
        return [np.concatenate((ids[a:b], end)) for a, b in zip(bounds, bounds[1:])]


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: the items of each window."""
    if not lengths:
        return [[] for _ in range(windows)]
    heap = []
    for i, n in enumerate(lengths):
        # a partial partition: sums in descending order, and their items.
        # Only windows that hold something are listed; the others are 0.
        heap.append((-n, i, [n], [[i]]))
    heapq.heapify(heap)
    tie = len(lengths)
    while len(heap) > 1:
        _, _, a, ai = heapq.heappop(heap)
        _, _, b, bi = heapq.heappop(heap)
        if len(a) + len(b) <= windows:
            sums, items = a + b, ai + bi
        else:
            # the fullest of one meet the emptiest of the other
            free = windows - len(a)
            sums = a + [0] * free
            items = ai + [[] for _ in range(free)]
            for k in range(len(b)):
                sums[windows - 1 - k] += b[k]
                items[windows - 1 - k] = items[windows - 1 - k] + bi[k]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[k] for k in order], [items[k] for k in order]
        if len(sums) == windows:
            low = sums[-1]
            spread = sums[0] - low
        else:
            spread = sums[0]
        heapq.heappush(heap, (-spread, tie, sums, items))
        tie += 1
    items = heap[0][3]
    return items + [[] for _ in range(windows - len(items))]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``, as few as differencing reaches."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        got = differencing(lengths, windows)
        if all(sum(lengths[i] for i in w) <= capacity for w in got):
            return got
        windows += 1


class _Packer:
    """Packs the documents of one task, batch by batch."""

    def __init__(self, task: int, capacity: int, batch: int, slack: int):
        self.next_id, self.capacity = task << 40, capacity
        self.room = batch * capacity - batch * slack
        self.pieces: list[tuple] = []  # doc, start, doc tokens, ids
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        n, c, start = len(ids), self.capacity, 0
        while n - start >= c:
            yield self._row(doc, start, n, ids[start : start + c], self._new_id(), 0)
            start += c
        while start < n:
            part = ids[start : start + max(1, min(n - start, self.room - self.held))]
            self.pieces.append((doc, start, n, part))
            self.held += len(part)
            start += len(part)
            if self.held >= self.room:
                yield from self.close()

    def close(self) -> Iterator[tuple]:
        for window in pack_lengths([len(p[3]) for p in self.pieces], self.capacity) if self.pieces else ():
            if not window:
                continue
            sequence, at = self._new_id(), 0
            for i in window:
                doc, start, n, part = self.pieces[i]
                yield self._row(doc, start, n, part, sequence, at)
                at += len(part)
        self.pieces, self.held = [], 0

    def _new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    @staticmethod
    def _row(doc, start, n, part, sequence, at) -> tuple:
        return doc, start, len(part), n, sequence, at, part.astype("<u4").tobytes()


_TYPES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in _TYPES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _TYPES)], names=[n for n, _ in _TYPES])


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, batch: int = 128, slack: int = 36, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset in the sequence, and ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, end_id)
        packer = _Packer(TaskContext.get().partitionId(), capacity, batch, slack)
        rows: list[tuple] = []
        for b in slices(batches, text_col, PIECE):
            for doc, ids in zip(b.column(id_col).to_pylist(), words.encode(b.column(text_col))):
                rows.extend(packer.add(doc, ids))
            yield _batch(rows)
            rows = []
        yield _batch(list(packer.close()))

    return docs.select(id_col, text_col).mapInArrow(giving_back(run), SCHEMA)
