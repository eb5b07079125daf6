"""Exact top-k search by inner product over a bit-sliced index.

Every attribute (component) of the quantised vectors becomes a stack of
bitmaps, one for each binary digit, with one bit for each row of a block.  A
query adds the slices it selects with bitmap arithmetic: its component's
binary digits say which slices enter at which weight, carry-save adders reduce
them, and the result is again a bit-sliced number: the score of every row of
the block.  The k largest are selected from the most significant slice
downward; rows on the boundary tie exactly and are resolved by smallest id,
which is the order of the bits.

Blocks of rows meet blocks of queries, both bounded by bytes; each meeting
yields k rows a query, and a window keeps the k best.

Defined results.  A vector that is null or holds a null or non-finite component
(also after scaling) takes no part.  An empty vector scores 0 with everything;
shorter vectors count as padded with zeros.  Rows that repeat an id are rows of
their own, told apart by a row number: a query's candidates are all rows but
its own.  A null id is no query and comes after all ids among equal scores.
Vectors with components of 2**26 and more stay out of the index; their scores
are exact integer products.  A score beyond 64 bits counts as the largest
bigint.  Other columns are not read.  Empty tables give an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.hard_negatives import BLOCK_BYTES, MEETINGS_PER_CORE, as_type, blocks_of, long_scores, matrix, meet, quantised, usable, width_of
from pitwall.llm.shared import staged

#: Quantised components of this size and more stay out of the index.
LARGE = 1 << 26
#: A block of queries holds so many at least, for which an index is built.
FEWEST_QUERIES = 64
_LAST = (1 << 63) - 1


def _small(values: np.ndarray) -> np.ndarray:
    """Which rows the index can hold."""
    return ((values > -LARGE) & (values < LARGE)).all(axis=1)


def _exact(ids: np.ndarray, rows: np.ndarray, values: np.ndarray, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (place, score) among all rows but the query's own."""
    others = np.flatnonzero(rows != own)
    scores = long_scores(as_type(values[others], object) @ as_type(query[None], object)[0]) if len(others) else []
    scored = zip(others.tolist(), scores, ids[others].tolist())
    return [(i, s) for i, s, _ in heapq.nsmallest(k, scored, key=lambda x: (-x[1], x[2]))]


class BitSlices:
    """Index of one block: its rows in order of their ids and, per attribute, the
    slices of (value - smallest value of the attribute)."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.order = np.argsort(ids, kind="stable")
        values = values[self.order].astype(np.int64)
        if len(values) and not _small(values).all():
            raise ValueError("components are too large for the index")
        n, self.width = values.shape
        self.low = values.min(axis=0)
        self.span = values.max(axis=0) - self.low
        self.words = -(-n // 64)
        self.n = n
        self.slices: list[list[np.ndarray]] = []
        for d in range(self.width):
            shifted = (values[:, d] - self.low[d]).astype(np.uint64)
            depth = int(self.span[d]).bit_length()
            self.slices.append([self._bitmap((shifted >> np.uint64(b)) & np.uint64(1)) for b in range(depth)])
        self.all = self._bitmap(np.ones(n, np.uint64))
        self.flipped = [[s ^ self.all for s in column] for column in self.slices]

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        out = np.zeros(self.words * 8, np.uint8)
        out[: len(packed)] = packed
        return out.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray | None], int]:
        """Bit-sliced scores (least significant slice first) and what is to be
        added to each.  A negative component adds the complement slices."""
        columns: list[list[np.ndarray]] = []
        base = 0
        for d, q in enumerate(query.tolist()[: self.width]):
            size, stack = abs(q), self.slices[d] if q >= 0 else self.flipped[d]
            # complement of v over depth bits is (2**depth - 1 - v)
            base += q * int(self.low[d]) + (0 if q >= 0 else q * ((1 << len(stack)) - 1))
            bit = 0
            while size:
                if size & 1:
                    while len(columns) < bit + len(stack):
                        columns.append([])
                    for b, s in enumerate(stack):
                        columns[bit + b].append(s)
                size >>= 1
                bit += 1
        out: list[np.ndarray | None] = []
        p = 0
        while p < len(columns):
            here = columns[p]
            if len(here) >= 2 and p + 1 == len(columns):
                columns.append([])
            while len(here) >= 3:
                a, b, c = here.pop(), here.pop(), here.pop()
                ab = a ^ b
                here.insert(0, ab ^ c)
                columns[p + 1].append((a & b) | (ab & c))
            if len(here) == 2:
                a, b = here
                columns[p + 1].append(a & b)
                here = [a ^ b]
            out.append(here[0] if here else None)
            p += 1
        return out, base

    def top(self, scores: list[np.ndarray | None], k: int, without: int | None) -> np.ndarray:
        """Row numbers of the k largest, from the top slice downward; rows equal
        on every slice are taken in order of their bits."""
        even = self.all
        if without is not None:
            even = even.copy()
            even[without >> 6] &= ~(np.uint64(1) << np.uint64(without & 63))
        sure = np.zeros_like(even)
        have = 0
        for s in reversed(scores):
            if s is None:
                continue
            ones = even & s
            n = int(np.bitwise_count(ones).sum())
            if have + n > k:
                even = ones
            else:
                sure |= ones
                have += n
                even = even & ~s
                if have == k:
                    return self._rows(sure)
        return np.concatenate((self._rows(sure), self._rows(even, k - have)))

    def _rows(self, bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        if most is not None:
            words = words[:most]
        bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
        w, b = np.nonzero(bits)
        rows = words[w] * 64 + b
        return rows if most is None else rows[:most]

    @staticmethod
    def values(scores: list[np.ndarray | None], rows: np.ndarray, base: int) -> np.ndarray:
        out = np.full(len(rows), base, np.int64)
        for p, s in enumerate(scores):
            if s is not None:
                out += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << p
        return out


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        asked: list[int] = []
        if rows.num_rows and queries.num_rows:
            width = max(width_of(rows["v"]), width_of(queries["q"]))
            values, wanted = matrix(rows["v"], width), matrix(queries["q"], width)
            number = rows["row"].to_numpy()
            ids = rows["id"].combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
            small, fits = _small(values), _small(wanted)
            inside, outside = np.flatnonzero(small), np.flatnonzero(~small)
            index = BitSlices(ids[inside], values[inside]) if len(inside) else None
            place = dict(zip(number[inside][index.order].tolist(), range(len(inside)))) if index else {}
            for at, (own, query) in enumerate(zip(queries["anchor"].to_pylist(), wanted)):
                whole = index is None or not fits[at]
                part = np.arange(len(ids)) if whole else outside
                best = [(part[i], s) for i, s in _exact(ids[part], number[part], values[part], own, query, k)] if len(part) else []
                if not whole:
                    sums, base = index.scores(query.astype(np.int64))
                    top = index.top(sums, k, place.get(own))
                    best += zip(inside[index.order[top]], index.values(sums, top, base).tolist())
                asked.extend([at] * len(best))
                found[0].extend(i for i, _ in best)
                found[1].extend(long_scores(s for _, s in best))
        taken = pa.array(asked, pa.int64())
        return pa.table({
            "anchor": queries["anchor"].combine_chunks().cast(pa.int64()).take(taken), "query_id": queries["query_id"].combine_chunks().cast(pa.int64()).take(taken),
            "vec_id": rows["id"].combine_chunks().cast(pa.int64()).take(pa.array(found[0], pa.int64())), "score": pa.array(found[1], pa.int64()),
        })

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` holds,
    its k best among all other rows."""
    rows = staged(
        vectors.where(usable(F.col(vector_col), scale)).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"),
            (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("asks"),
        ),
        "topk-rows",
    )
    n, n_queries, width = rows.agg(F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    # An index of many rows answers a query in fewer, longer array operations, so
    # rows are cut by bytes alone; the queries are dealt out to the cores.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    row_blocks, query_blocks = blocks_of(n, n_queries, width, 0, block_bytes)
    dealt = min(-(-MEETINGS_PER_CORE * cores // row_blocks), n_queries // FEWEST_QUERIES)
    blocks = row_blocks, max(query_blocks, dealt)
    queries = rows.where("asks").select(F.col("row").alias("anchor"), F.col("id").alias("query_id"), F.col("v").alias("q"))
    best = meet(rows.drop("asks"), queries, blocks, _search(k), "anchor long, query_id long, vec_id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
