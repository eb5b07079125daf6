"""Toxicity: a character n-gram linear classifier whose features are scaled by
naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram (3 to 5 characters of the
lower-case text between blanks; every white space is a blank).  Its value is the log of
how much likelier the n-gram is in positive than in negative training texts,
smoothed; n-grams whose ratio is within chance are left out.  A logistic
regression over those scaled features gives the weights.  Its margins are
calibrated on rows left out of a fit (three folds), for the share of label 1
among all training labels.  Training uses a bounded sample of labelled rows (see
``classify.training_sample``); scoring reads every whole text.

Defined results.  A null text counts as empty; texts without a known n-gram
get the score of the intercept.  Each row is scored by its own text, repeated
or not.  Without training rows of both labels every score is 0.  An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType

from pitwall.llm.classify import MOST_BYTES, MOST_ROWS, by_bytes, label_counts, logistic, training_sample
from pitwall.llm.shared import byte_table, give_back, giving_back, kept, mix, slices, string_buffers

SIZES = (3, 4, 5)
BITS = 20
PIECE = 1 << 20
#: Bytes of texts scored at once: a worker takes some 100 bytes for each.
SCORED = 1 << 17
_TABLE = byte_table(23)
_SEED = np.uint64((23 * 1000003 + 1) * 256)
_TABLE[[9, 10, 11, 12, 13]] = _TABLE[32]


def _hashed(points: np.ndarray) -> np.ndarray:
    """A hash of each code point; below 256 those of ``_TABLE``."""
    out = _TABLE[np.minimum(points, 255)]
    wide = np.flatnonzero(points > 255)
    out[wide] = mix(points[wide].astype(np.uint64) + _SEED)
    return out


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams of the texts (code points of their
    lower-case form, a blank on each side), and the text number of each."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    blank = pa.scalar(" ", pa.large_string())
    return _rolled(pc.binary_join_element_wise(blank, pc.utf8_lower(col), blank, pa.scalar("", pa.large_string())))


def _rolled(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, _ = string_buffers(col)
    data = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    text_of = np.repeat(np.arange(len(col), dtype=np.int32), pc.utf8_length(col).to_numpy(zero_copy_only=False))
    one = _hashed(data)
    rolled = one
    buckets, owners = [], []
    for n in range(2, max(SIZES) + 1):
        if len(data) < n:
            break
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[n - 1 :]
        if n in SIZES:
            whole = text_of[n - 1 :] == text_of[: len(data) - n + 1]
            h = mix(rolled + np.uint64(n)) >> np.uint64(64 - BITS)
            buckets.append(h[whole].astype(np.int32))
            owners.append(text_of[: len(data) - n + 1][whole])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(owners)


def _by_slice(column: pa.Array, wanted: np.ndarray | None, piece: int) -> Iterator[np.ndarray]:
    for lo, some in by_bytes(column, piece):
        long = len(some) == 1 and (pc.utf8_length(some)[0].as_py() or 0) > piece
        text = f" {pc.utf8_lower(some.cast(pa.large_string()))[0].as_py()} " if long else ""
        found = np.zeros(0, np.int64)
        for at in range(0, len(text) or 1, piece):
            buckets, owners = _rolled(pa.array([text[at : at + piece + max(SIZES) - 1]], pa.large_string())) if long else grams(some)
            if wanted is not None:
                used = np.flatnonzero(wanted[buckets])
                buckets, owners = buckets[used], owners[used]
            new = np.unique((owners.astype(np.int64) + lo) << BITS | buckets)
            found = np.union1d(found, new) if len(found) else new
        yield found


def distinct_grams(column: pa.Array, wanted: np.ndarray | None = None, piece: int = PIECE) -> np.ndarray:
    """The distinct (text, bucket) of a column as text << BITS | bucket, sorted;
    with ``wanted`` only buckets where it is not 0.  A text of more than
    ``piece`` characters is read in pieces that overlap by one n-gram, so the
    memory for a long text follows the buckets and not its length."""
    return np.concatenate([np.zeros(0, np.int64), *_by_slice(column, wanted, piece)])


def common_grams(column: pa.Array, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of the distinct grams of a sample whose bucket occurs in
    ``least`` texts or more: fewer never get a ratio (see ``ratios``)."""
    counts, parts = np.zeros(1 << BITS, np.int32), []
    for pairs in _by_slice(column, None, PIECE):
        text, bucket = (pairs >> BITS).astype(np.int32), (pairs & ((1 << BITS) - 1)).astype(np.int32)
        counts += np.bincount(bucket, minlength=1 << BITS).astype(np.int32)
        parts.append((text, bucket))
    for k, (text, bucket) in enumerate(parts):
        often = counts[bucket] >= least
        parts[k] = text[often], bucket[often]
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *(t for t, _ in parts)]), np.concatenate([none, *(b for _, b in parts)])


def telling_grams(column: pa.Array, labels: np.ndarray, part: np.ndarray, folds: int, alpha: float = 1.0, chance: float = 3.5) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of the distinct grams of a sample whose bucket has a ratio
    in the fit on all texts or in one that leaves out a ``part``.  Counted by
    part and label first, then read again, so that no list of all grams is held."""
    counts = np.zeros((folds, 2, 1 << BITS), np.int32)
    for pairs in _by_slice(column, None, PIECE >> 2):
        text, bucket = pairs >> BITS, pairs & ((1 << BITS) - 1)
        of = part[text] * 2 + (labels[text] == 1)
        for k in np.unique(of).tolist():
            counts[k // 2, k % 2] += np.bincount(bucket[of == k], minlength=1 << BITS).astype(np.int32)
    rows = np.bincount(part * 2 + (labels == 1), minlength=2 * folds).reshape(folds, 2)
    whole, all_rows = counts.sum(axis=0, dtype=np.int32), rows.sum(axis=0)
    telling = np.zeros(1 << BITS, bool)
    for out, left in ((0, 0), *zip(counts, rows)):
        telling |= _ratio(*(whole - out)[::-1], *(all_rows - left)[::-1].tolist(), alpha, chance) != 0
    del counts, whole
    pairs = distinct_grams(column, telling, PIECE >> 2)
    return (pairs >> BITS).astype(np.int32), (pairs & ((1 << BITS) - 1)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # by bucket: log-count ratio times weight, mostly 0
    intercept: float

    def margin(self, column: pa.Array) -> np.ndarray:
        pairs = distinct_grams(column, self.weights, SCORED)
        return self.intercept + np.bincount(pairs >> BITS, self.weights[pairs & ((1 << BITS) - 1)], len(column))

    def score(self, column: pa.Array) -> np.ndarray:
        return logistic(self.margin(column))


def fit(column: pa.Array, labels: np.ndarray, alpha: float = 1.0, chance: float = 3.5, l2: float = 2.0, steps: int = 300) -> Model:
    """Log-count ratios, then logistic regression on the scaled features."""
    return _fit(*common_grams(column), labels, alpha, chance, l2, steps)


def ratios(text: np.ndarray, bucket: np.ndarray, labels: np.ndarray, alpha: float = 1.0, chance: float = 3.5) -> np.ndarray:
    """Smoothed log-count ratio of each bucket, 0 where it lies within chance
    or the bucket occurs in fewer than five texts."""
    positive = labels == 1
    p = np.bincount(bucket[positive[text]], minlength=1 << BITS)
    q = np.bincount(bucket[~positive[text]], minlength=1 << BITS)
    return _ratio(p, q, int(positive.sum()), int((~positive).sum()), alpha, chance)


def _ratio(p: np.ndarray, q: np.ndarray, n1: int, n0: int, alpha: float, chance: float) -> np.ndarray:
    """From the texts with each bucket among n1 with label 1 and n0 with label 0."""
    ratio = np.log((p + alpha) / (n1 + 2 * alpha)) - np.log((q + alpha) / (n0 + 2 * alpha))
    # standard error of the log ratio: what lies within chance carries nothing
    error = np.sqrt(1 / (p + alpha) - 1 / (n1 + 2 * alpha) + 1 / (q + alpha) - 1 / (n0 + 2 * alpha))
    ratio[(np.abs(ratio) < chance * error) | (p + q < 5)] = 0
    return ratio


def _fit(text: np.ndarray, bucket: np.ndarray, labels: np.ndarray, alpha: float = 1.0, chance: float = 3.5, l2: float = 2.0, steps: int = 300) -> Model:
    weights = np.zeros(1 << BITS, np.float32)
    positive = labels == 1
    if not positive.any() or positive.all():
        return Model(weights, -40.0)
    n1, n0 = int(positive.sum()), int((~positive).sum())
    ratio = ratios(text, bucket, labels, alpha, chance)
    known = ratio[bucket] != 0
    text, bucket = text[known], bucket[known]
    chosen = np.flatnonzero(ratio)
    number = np.zeros(1 << BITS, np.int32)
    number[chosen] = np.arange(len(chosen))
    column_of = number[bucket]
    value = ratio[chosen][column_of]
    y, n = labels.astype(np.float64), len(labels)
    w, b = np.zeros(len(chosen)), 0.0
    # Nesterov steps with a safe step size; balanced classes, so that the
    # weights do not depend on how the sample was drawn
    norm = np.bincount(text, value**2, n).max() if len(value) else 1.0
    rate = 4.0 / (norm + 1.0) / 4
    share = np.where(positive, 0.5 / n1, 0.5 / n0) * n
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(steps):
        aw, ab = w + 0.9 * vw, b + 0.9 * vb
        g = share * (logistic(ab + np.bincount(text, value * aw[column_of], n)) - y)
        gw = np.bincount(column_of, value * g[text], len(chosen)) / n + l2 * aw / n
        vw, vb = 0.9 * vw - rate * 10 * gw, 0.9 * vb - rate * 10 * g.mean()
        w, b = w + vw, b + vb
    weights[chosen] = ratio[chosen] * w
    return Model(weights, float(b))


def calibration(margin: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift that turn margins into log odds of label 1 where that
    label has this share (Newton steps on the logistic loss, targets smoothed
    by one row of each label)."""
    n1, n0 = int((labels == 1).sum()), int((labels != 1).sum())
    t = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, share / max(n1, 1), (1 - share) / max(n0, 1)) * len(labels)
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    at = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((weight * (np.logaddexp(0, z) - t * z)).sum())

    for _ in range(50):
        p = logistic(x @ at)
        gradient = x.T @ (weight * (p - t))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-4 and loss(at - size * move) > loss(at):
            size /= 2
        at = at - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def fit_calibrated(column: pa.Array, labels: np.ndarray, share: float, folds: int = 3, **options) -> Model:
    """A fit on all rows whose margins are calibrated on rows left out: each of
    ``folds`` parts is scored by a fit on the others.  Parts hold whole groups of
    equal texts."""
    same = np.unique(pc.dictionary_encode(pc.fill_null(column, "")).indices.to_numpy(), return_inverse=True)[1] % folds
    text, bucket = telling_grams(column, labels, same, folds, **{k: options[k] for k in ("alpha", "chance") if k in options})
    model = _fit(text, bucket, labels, **options)
    margin = np.zeros(len(labels))
    for k in range(folds):
        out = same == k
        if not out.any() or len(np.unique(labels[~out])) < 2:
            return model
        kept = (np.cumsum(~out) - 1).astype(np.int32)  # row numbers among the rows of the fit
        of = out[text]
        part = _fit(kept[text[~of]], bucket[~of], labels[~out], **options)
        margin[out] = (part.intercept + np.bincount(text[of], part.weights[bucket[of]], len(labels)))[out]
    slope, shift = calibration(margin, labels, share)
    return Model(model.weights * np.float32(slope), model.intercept * slope + shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Model:
    sample = training_sample(docs, labels, label, most_rows, most_bytes)
    n0, n1 = label_counts(labels, label)
    model = fit_calibrated(sample.column("text").combine_chunks(), sample.column("__label").to_numpy().astype(np.int64), (n1 + 1) / (n0 + n1 + 2))
    del sample
    give_back()  # the driver lives on, too
    return model


def score(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text", threshold: float = 0.5, added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``columns`` of ``docs`` with score and predicted, named as in ``added``."""
    spark = docs.sparkSession
    used = np.flatnonzero(model.weights).astype(np.int32)
    shared = spark.sparkContext.broadcast((used, model.weights[used], model.intercept))  # at most 2**20 weights
    key = "toxicity", uuid.uuid4().hex

    def local_model() -> Model:
        at, w, b = shared.value
        weights = np.zeros(1 << BITS, np.float32)
        weights[at] = w
        return Model(weights, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = kept(key, local_model)
        for batch in slices(batches, text_col, SCORED):
            s = local.score(batch.column(text_col))
            cols = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=names)

    names = [*columns, *added]
    picked = docs.select(*dict.fromkeys([*columns, text_col]))
    schema = picked.select(*columns).schema.add(names[-2], DoubleType()).add(names[-1], IntegerType())
    return picked.mapInArrow(giving_back(run), schema)
