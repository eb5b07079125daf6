"""Hard-negative mining by inner product with Fagin's threshold algorithm.

Blocks of candidates keep one sorted list of their rows for every dimension.
An anchor reads all lists in parallel from the end its own sign favours: a
positive component from the largest value down, a negative one from the
smallest up, a zero not at all (sorted access).  A row met for the first time
is scored at once by its whole vector in integers (random access).  After each
step the threshold is the score a row would have whose every component equals
the last one read; no row still unmet scores more.  A search ends once the
threshold lies strictly below the k-th score found (equal scores could still
win by a smaller id), or when every row has been met.

Two searches follow each other: the k best rows of the anchor's own label are
its positives; each positive's score p sets a window of scores, from ``low``
to ``high`` percent of p, in which the first rows of other labels are its
negatives.  The second search ends once the threshold is strictly below the
last kept score of every window, or below the window where it is not full.

Blocks of anchors meet blocks of candidates, all rows against the stated set of
anchors; each meeting returns k rows for an anchor or window at most, and a
window function keeps the best.  Blocks are bounded by bytes on both sides.

Defined results.  Rows with a null label, a null vector, or any null or
non-finite component (also after scaling) take no part.  An empty vector scores
0 with everything; shorter vectors count as padded with zeros.  Rows that
repeat an id are separate rows, told apart by a row number; an anchor is never
its own positive.  A null id is no anchor, keeps its label, and comes after all
ids among equal scores.  A window that is empty (any negative positive score)
returns nothing.  Scores are exact for components of any size; beyond 64 bits
they count as the largest bigint.  Other columns are not read.  Empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.shared import staged

#: Bytes of a block of candidates and of a block of anchors, as doubles.
BLOCK_BYTES = 16 << 20
#: Small inputs are cut finer so that this many meetings keep a core busy.
MEETINGS_PER_CORE = 3
FEWEST_ROWS, FEWEST_ANCHORS = 2048, 64
#: Depth of the first step of sorted access; each further step is twice as deep.
FIRST_STEP = 64
_MOST = (1 << 63) - 1


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as a double, exact at any size."""
    scaled = lambda x: x.cast("double") * float(scale)
    return F.transform(vector, lambda x: F.when(F.abs(scaled(x)) >= float(1 << 53), scaled(x)).otherwise(F.floor(scaled(x)).cast("double")))


def usable(vector: Column, scale: int) -> Column:
    infinite = lambda x: F.abs(x.cast("double") * float(scale)) == float("inf")
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | infinite(x))


# -- one block -------------------------------------------------------------

def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as float64, padded with zeros to ``width``."""
    out = np.zeros((len(column), width))
    at = 0
    for chunk in column.chunks:
        ends = chunk.offsets.to_numpy()
        lengths, flat = np.diff(ends), chunk.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        rows = np.repeat(np.arange(len(lengths)), lengths)
        out[at + rows, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
        at += len(lengths)
    return out


def width_of(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max()) for c in column.chunks if len(c)), default=0)


def exact_type(values: np.ndarray, queries: np.ndarray) -> type:
    """The narrowest type in which every inner product and every partial sum is
    an exact integer: float32 below 2**24, float64 below 2**53, else Python's."""
    if not values.size or not queries.size:
        return np.float64
    most = float(np.abs(values).max()) * float(np.abs(queries).sum(axis=1).max())
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def as_type(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


class SortedLists:
    """Rows of a block with one list for each dimension, sorted by value."""

    def __init__(self, values: np.ndarray):
        self.values, self.n = values, len(values)
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T.astype(np.int32))
        self.sorted = np.ascontiguousarray(np.take_along_axis(values.T, self.order, axis=1)) if values.size else values.T

    def search(self, query: np.ndarray, passed: np.ndarray, settled: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Rows met and their scores, by sorted and random access.  Rows marked
        in ``passed`` are never scored; ``settled(threshold, scores)`` says
        whether no row still unmet can matter."""
        seen = passed.copy()
        left = self.n - int(seen.sum())
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        rows_met, scores, place = [], [], np.empty(self.n, np.int32)
        depth, step = 0, FIRST_STEP
        while left and depth < self.n:
            end = min(self.n, depth + step)
            read = np.concatenate((self.order[up, self.n - end : self.n - depth].ravel(), self.order[down, depth:end].ravel()))
            if not len(read):  # all components are zero: every score is
                read, end = np.arange(self.n, dtype=np.int32), self.n
            read = read[~seen[read]]
            if len(read):
                count = np.arange(len(read), dtype=np.int32)
                place[read] = count
                read = read[place[read] == count]  # each row once
                seen[read] = True
                left -= len(read)
                rows_met.append(read)
                scores.append(self.values[read] @ query)
            depth, step = end, step * 2
            if left and depth < self.n:
                threshold = int((query[up] * self.sorted[up, self.n - end]).sum()) + int((query[down] * self.sorted[down, end - 1]).sum())
                if settled(threshold, scores):
                    break
        if not rows_met:
            return np.zeros(0, np.int32), np.zeros(0)
        return np.concatenate(rows_met), np.concatenate(scores)


def first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id."""
    if len(rows) > k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
    else:
        near = np.arange(len(rows))
    return near[np.lexsort((ids[rows[near]], -scores[near]))[:k]] if scores.dtype != object else np.array(sorted(near, key=lambda i: (-scores[i], ids[rows[i]]))[:k], np.int64)


def _kth(scores: list[np.ndarray], k: int, high: int | None = None) -> int | None:
    """The k-th highest score found that is at most ``high``."""
    kept = [s if high is None else s[s <= high] for s in scores]
    met = np.concatenate(kept) if kept else np.zeros(0)
    if len(met) < k:
        return None
    return int(sorted(met)[-k] if met.dtype == object else np.partition(met, len(met) - k)[len(met) - k])


def long_scores(scores) -> list[int]:
    return [max(-_MOST, min(_MOST, int(s))) for s in scores]


def _sides(rows: pa.Table, anchors: pa.Table) -> tuple:
    width = max(1, width_of(rows["v"]), width_of(anchors["q"]))
    values, queries = matrix(rows["v"], width), matrix(anchors["q"], width)
    kind = exact_type(values, queries)
    number = lambda t, c: t[c].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = rows["id"].combine_chunks().fill_null(_MOST).to_numpy(zero_copy_only=False)
    return as_type(values, kind), as_type(queries, kind), number(rows, "row"), ids, number(rows, "label"), number(anchors, "anchor"), number(anchors, "anchor_label")


def _positives(k: int) -> Callable:
    """Best rows of the anchor's label in one block of candidates."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and anchors.num_rows:
            values, queries, row, ids, labels, anchor, anchor_label = _sides(rows, anchors)
            for label in np.unique(anchor_label):
                own = np.flatnonzero(labels == label)
                if not len(own):
                    continue
                lists = SortedLists(values[own])
                for a in np.flatnonzero(anchor_label == label):
                    itself = row[own] == anchor[a]
                    met, scores = lists.search(queries[a], itself, lambda t, s: (kth := _kth(s, k)) is not None and t < kth)
                    best = first(met, scores, ids[own], k)
                    found[0].extend([anchor[a]] * len(best))
                    found[1].extend(own[met[best]])
                    found[2].extend(long_scores(scores[best]))
        return _found(rows, found, {"anchor": pa.array(found[0], pa.int64())})

    return run


def _negatives(k: int) -> Callable:
    """Best rows of other labels in each window, in one block of candidates."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: tuple[list, list, list, list] = ([], [], [], [])
        if rows.num_rows and anchors.num_rows:
            values, queries, row, ids, labels, anchor, anchor_label = _sides(rows, anchors)
            windows = anchors["windows"].to_pylist()
            lists = SortedLists(values)
            for label in np.unique(anchor_label):
                same = labels == label
                for a in np.flatnonzero(anchor_label == label):
                    spans = [(w["low"], w["high"]) for w in windows[a]]

                    def settled(threshold, scores, spans=spans):
                        if threshold >= max(high for _, high in spans):
                            return False
                        for low, high in spans:
                            kth = _kth(scores, k, high)
                            if threshold >= (low if kth is None else max(low, kth)):
                                return False
                        return True

                    met, scores = lists.search(queries[a], same, settled)
                    for w, (low, high) in zip(windows[a], spans):
                        inside = np.flatnonzero((scores >= low) & (scores <= high))
                        best = inside[first(met[inside], scores[inside], ids, k)]
                        found[0].extend([anchor[a]] * len(best))
                        found[1].extend(met[best])
                        found[2].extend(long_scores(scores[best]))
                        found[3].extend([w["rank"]] * len(best))
        return _found(rows, found, {"anchor": pa.array(found[0], pa.int64()), "window": pa.array(found[3], pa.int32())})

    return run


def _found(rows: pa.Table, found: tuple, more: dict) -> pa.Table:
    ids = rows["id"].combine_chunks().cast(pa.int64()).take(pa.array(found[1], pa.int64()))
    return pa.table({**more, "id": ids, "score": pa.array(found[2], pa.int64())})


# -- the job ---------------------------------------------------------------

def blocks_of(n: int, anchors: int, width: int, cores: int, block_bytes: int) -> tuple[int, int]:
    """How many blocks of candidates and of anchors: bounded by bytes, and cut
    finer where the input is small, so that the cores have work."""
    each = max(1, width) * 8
    wanted = max(1, int((MEETINGS_PER_CORE * cores) ** 0.5) + 1)
    by_bytes = lambda x: -(-x * each // block_bytes)
    return (max(1, by_bytes(n), min(wanted, n // FEWEST_ROWS)), max(1, by_bytes(anchors), min(wanted, anchors // FEWEST_ANCHORS)))


def meet(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], run: Callable, schema: str) -> DataFrame:
    """Every block of candidates with every block of anchors, once."""
    number = lambda count, by: F.pmod(F.xxhash64(by), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = rows.withColumn("rb", number(blocks[0], "row")).withColumn("qb", every(blocks[1]))
    right = anchors.withColumn("qb", number(blocks[1], "anchor")).withColumn("rb", every(blocks[0]))
    return left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(lambda a, b: run(a, b), schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, *, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each row where ``is_anchor`` holds and each of its positives, the first
    negatives whose score is ``low`` to ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    rows = staged(
        vectors.where(label.isNotNull() & usable(F.col(vector_col), scale)).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
            quantised(F.col(vector_col), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        ),
        "negatives-rows",
    )
    n, n_anchors, width = rows.agg(F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = blocks_of(n, n_anchors, width, spark.sparkContext.defaultParallelism, block_bytes)
    candidates = rows.drop("anchor")
    anchors = rows.where("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("v").alias("q"))
    near = meet(candidates, anchors.drop("anchor_id"), blocks, _positives(positives), "anchor long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    wide = lambda c, by: c.cast("decimal(38,0)") * by
    lowest = F.ceil(wide(F.col("score"), low) / 100).cast("long")
    highest = F.floor(wide(F.col("score"), high) / 100).cast("long")
    chosen = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).select("anchor", "rank", "id", "score", lowest.alias("low"), highest.alias("high"))
    chosen = staged(chosen, "negatives-positives")
    windows = chosen.where(F.col("low") <= F.col("high")).groupBy("anchor").agg(F.collect_list(F.struct("rank", "low", "high")).alias("windows"))
    asking = anchors.drop("anchor_id").join(windows, "anchor")
    mined = meet(candidates, asking, blocks, _negatives(negatives), "anchor long, window int, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = mined.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= negatives)
    p = chosen.select("anchor", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors.select("anchor", "anchor_id"), "anchor")
    return best.join(p, ["anchor", "window"]).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
