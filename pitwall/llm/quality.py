"""Quality classifier: a factorisation machine.

Inputs are hashed words (presence), structure statistics of the text and its
length as metadata.  The score is w0 + sum w_i x_i plus all pairwise
interactions <v_i, v_j> x_i x_j of low rank, computed in linear time by the
sum-of-squares identity: half of (sum v x)**2 - sum (v x)**2 for each factor.
It is fitted by AdaGrad steps on the logistic loss over a bounded sample of
labelled rows; scoring reads every whole text.

Defined results.  A null text counts as empty; an empty text is scored by its
statistics.  Each row is scored by its own text, repeated or not.  Without
training rows of both labels every score is that of the only label (0 if there
are none).  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType

from pitwall.llm.classify import MOST_BYTES, MOST_ROWS, by_bytes, label_counts, logistic, training_sample
from pitwall.llm.shared import byte_table, prefix_sums, runs_inside, slice_hash, slices, string_buffers, word_slices

BITS, RANK = 16, 8
_TABLE = byte_table(31)
#: Structure statistics: ranges of bytes whose share of the text is taken.
_SHARES = {
    "letters": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "upper": list(range(65, 91)),
    "digits": list(range(48, 58)),
    "blanks": [9, 10, 11, 12, 13, 32],
    "lines": [10],
    "stops": [33, 46, 63],
    "commas": [44, 58, 59],
    "symbols": [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126],
}
STATISTICS = len(_SHARES) + 7


@dataclass
class Features:
    word: np.ndarray  # bucket of each distinct word of each text
    owner: np.ndarray  # its text
    value: np.ndarray  # 1 / sqrt(distinct words of the text)
    dense: np.ndarray  # texts x STATISTICS


def _share_of(sums: np.ndarray, off: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (sums[off[1:]] - sums[off[:-1]]) / np.maximum(size, 1)


def features(column: pa.Array) -> Features:
    col = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    data, off = string_buffers(col)
    raw, raw_off = string_buffers(column)
    n = len(off) - 1
    size = np.diff(raw_off).astype(np.float64)
    dense = np.zeros((n, STATISTICS))
    for k, members in enumerate(_SHARES.values()):
        table = np.zeros(256, np.int64)
        table[members] = 1
        dense[:, k] = _share_of(np.concatenate(([0], np.cumsum(table[raw]))), raw_off, size)
    k = len(_SHARES)
    starts, ends, first = word_slices(data, off)
    counts = np.diff(first)
    lengths = np.concatenate(([0], np.cumsum(ends - starts)))
    squares = np.concatenate(([0], np.cumsum((ends - starts) ** 2)))
    some = np.maximum(counts, 1)
    mean = (lengths[first[1:]] - lengths[first[:-1]]) / some
    dense[:, k] = np.log1p(size) / 10
    dense[:, k + 1] = mean / 10
    dense[:, k + 2] = np.sqrt(np.maximum((squares[first[1:]] - squares[first[:-1]]) / some - mean**2, 0)) / 10
    hashes = slice_hash(prefix_sums(data, _TABLE), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), counts)
    bucket = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    pairs = np.unique(owner << BITS | bucket)
    distinct = np.bincount(pairs >> BITS, minlength=n)
    dense[:, k + 3] = distinct / some
    # how often a character or a line comes again
    again = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw[1:] == raw[:-1], out=again[2:]) if len(raw) > 1 else None
    dense[:, k + 4] = np.maximum(_share_of(again, raw_off, size), 0)
    ls, le, lf = runs_inside(raw != 10, raw_off)
    lines = np.diff(lf)
    lh = slice_hash(prefix_sums(raw, _TABLE), ls, le) >> np.uint64(24) if len(ls) else np.zeros(0, np.uint64)
    lo = np.repeat(np.arange(n), lines)
    order = np.lexsort((lh, lo))
    new = np.ones(len(lh), bool)
    new[1:] = (lh[order][1:] != lh[order][:-1]) | (lo[order][1:] != lo[order][:-1])
    dense[:, k + 5] = 1 - np.bincount(lo[order][new], minlength=n) / np.maximum(lines, 1)
    dense[:, k + 6] = 1.0 - (counts > 0)
    word, own = pairs & ((1 << BITS) - 1), pairs >> BITS
    return Features(word, own, 1 / np.sqrt(np.maximum(distinct, 1))[own], dense)


@dataclass
class Model:
    bias: float
    word_w: np.ndarray
    word_v: np.ndarray
    dense_w: np.ndarray
    dense_v: np.ndarray
    center: np.ndarray
    scale: np.ndarray

    def parts(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw scores, the factor sums of each text, and the dense inputs."""
        n = len(f.dense)
        x = np.clip((f.dense - self.center) / self.scale, -6, 6)
        out = self.bias + x @ self.dense_w + np.bincount(f.owner, self.word_w[f.word] * f.value, n)
        sums = x @ self.dense_v
        squares = (x**2) @ (self.dense_v**2).sum(axis=1)
        for r in range(self.word_v.shape[1]):
            t = self.word_v[f.word, r] * f.value
            sums[:, r] += np.bincount(f.owner, t, n)
            squares += np.bincount(f.owner, t * t, n)
        return out + 0.5 * ((sums**2).sum(axis=1) - squares), sums, x

    def score(self, column: pa.Array) -> np.ndarray:
        return logistic(self.parts(features(column))[0])


def fit(column: pa.Array, labels: np.ndarray, epochs: int = 30, batch: int = 200, rate: float = 0.08, decay: float = 1e-3, seed: int = 5) -> Model:
    """AdaGrad over minibatches; gradients of the factors follow the identity:
    d/dv = x (sum - v x)."""
    rng = np.random.default_rng(seed)
    shape = (1 << BITS, RANK)
    model = Model(0.0, np.zeros(1 << BITS), rng.normal(0, 0.02, shape), np.zeros(STATISTICS), rng.normal(0, 0.02, (STATISTICS, RANK)), np.zeros(STATISTICS), np.ones(STATISTICS))
    y, n = labels.astype(np.float64), len(labels)
    if not n or y.min() == y.max():
        model.word_v[:], model.dense_v[:], model.bias = 0, 0, 40.0 if n and y[0] else -40.0
        return model
    parts = [features(some) for _, some in by_bytes(column)]
    dense = np.concatenate([p.dense for p in parts])
    model.center, model.scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-3)
    words = np.concatenate([p.word for p in parts])
    values = np.concatenate([p.value for p in parts])
    counts = np.concatenate([np.bincount(p.owner, minlength=len(p.dense)) for p in parts])
    starts = np.cumsum(counts) - counts
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # balanced classes
    seen = {k: np.full_like(getattr(model, k), 1e-6) for k in ("word_w", "word_v", "dense_w", "dense_v")}
    seen_bias = 1e-6

    def step(name: str, at, gradient: np.ndarray) -> None:
        weights, total = getattr(model, name), seen[name]
        gradient = gradient + decay * weights[at]
        total[at] += gradient**2
        weights[at] -= rate * gradient / np.sqrt(total[at])

    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            rows = order[lo : lo + batch]
            at = np.repeat(starts[rows], counts[rows]) + np.arange(counts[rows].sum()) - np.repeat(np.cumsum(counts[rows]) - counts[rows], counts[rows])
            f = Features(words[at], np.repeat(np.arange(len(rows)), counts[rows]), values[at], dense[rows])
            raw, sums, x = model.parts(f)
            g = share[rows] * (logistic(raw) - y[rows]) / len(rows)
            seen_bias += g.sum() ** 2
            model.bias -= rate * g.sum() / np.sqrt(seen_bias)
            used, inverse = np.unique(f.word, return_inverse=True)
            weight = g[f.owner] * f.value
            gv = np.empty((len(used), RANK))
            square = np.bincount(inverse, weight * f.value, len(used))
            for r in range(RANK):
                gv[:, r] = np.bincount(inverse, weight * sums[f.owner, r], len(used)) - model.word_v[used, r] * square
            dv = x.T @ (g[:, None] * sums) - model.dense_v * ((x**2).T @ g)[:, None]
            step("dense_w", slice(None), x.T @ g)
            step("dense_v", slice(None), dv)
            step("word_w", used, np.bincount(inverse, weight, len(used)))
            step("word_v", used, gv)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Model:
    sample = training_sample(docs, labels, label, most_rows, most_bytes)
    model = fit(sample.column("text").combine_chunks(), sample.column("__label").to_numpy().astype(np.int64))
    # fitted on balanced classes; the shares of all training labels shift it back
    n0, n1 = label_counts(labels, label)
    model.bias += float(np.log((n1 + 1) / (n0 + 1)))
    return model


def score(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text", threshold: float = 0.3, added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``columns`` of ``docs`` with score and predicted, named as in ``added``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**16 x (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = shared.value
        for batch in slices(batches, text_col, 1 << 20):
            s = local.score(batch.column(text_col))
            cols = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=names)

    names = [*columns, *added]
    picked = docs.select(*dict.fromkeys([*columns, text_col]))
    schema = picked.select(*columns).schema.add(names[-2], DoubleType()).add(names[-1], IntegerType())
    return picked.mapInArrow(run, schema)
