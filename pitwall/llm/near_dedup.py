"""MinHash near-dedup by improved consistent weighted sampling (ICWS).

A document is the multiset of its shingles of five words.  A shingle weighs its
count in the document times its inverse document frequency over all documents,
ln(1 + N / max(df, N / 1000)): shingles rarer than one document in a thousand
weigh alike, so the table of the others is bounded by 1000 times the mean
count of shingles in a document, however large the corpus is, and can be sent
to every task.  Each ICWS sample draws a (shingle, level) pair that two
documents share with the probability of their weighted Jaccard similarity;
``rows`` samples make a band, and documents that share a band are candidates,
verified by that similarity computed from their whole shingle sets.

Two documents share at most the weight of what each has in common with any
other candidate, so a shingle that no other candidate has lowers the greatest
similarity its document can reach.  Documents that cannot reach the threshold
leave before any comparison, and the bound is taken anew among those that stay;
pairs that cannot reach it by their bounds are not compared.

Links inside a band's bucket are found without listing its pairs.  All members
are compared with one pivot, which then leaves.  Of two members that are not
connected yet, one is outside the largest component of their bucket: only such
members are pivots later, eight times as many each round.  Members of the
largest component that, by the triangle inequality (1 - weighted Jaccard is a
metric), cannot be near one of those leave, and so do buckets of one component.
Once what can still be near comes to a few pairs for each member, these are
compared directly.  Documents with the same words are one node throughout.
A bucket of many members lies in parts, by hashes of its nodes; what its members
meet (pivots, sizes, distances) is few and goes to each part.
Classes are the connected components of the links, by alternating star
contraction.

Defined results.  A null text counts as empty; a document without words is a
class of its own.  Documents of fewer than five words are one shingle.  A null
doc_id has part through its text; a class without ids has a null class id.
Fully repeated rows are one node and are marked alike.  Other columns are not
read.  An empty table gives an empty result.  Nodes and rows are told apart by
64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.config import conf_set
from pitwall.llm.shared import SliceTable, byte_table, fresh, giving_back, kept, mix, prefix_sums, sent_if_few, slice_hash, slices, staged, string_buffers, word_slices

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 9, 3
RARE = 1000
#: So few pairs are compared directly at any size.
FEWEST = 20_000
#: Texts that a task should read at least when heavy shingles are sought: in few
#: texts every shingle is heavy.
TEXTS = 10_000
#: Rows of an Arrow batch, and bytes of texts that a worker takes apart at once: a
#: worker keeps for its later tasks what it once needed.
BATCH_CONF, BATCH_ROWS, PIECE = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000, 1 << 19
#: Members of a bucket that lie together in one part, and the most buckets that
#: lie in several: there the parts grow.
PART, MOST_PARTED = 1 << 10, 1_000_000
_TABLE = byte_table(53)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _steps(n: int) -> np.uint64:
    return np.uint64(int(_STEP) * n % (1 << 64))


# -- shingles ----------------------------------------------------------------

def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, ...]:
    """Distinct shingles of each text in ascending order, their counts, the
    offsets of the texts, and a hash of each text's whole word sequence."""
    data, off = string_buffers(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    n = len(off) - 1
    starts, ends, first = word_slices(data, off)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64), np.zeros(n, np.uint64)
    word = slice_hash(prefix_sums(data, _TABLE), starts, ends)
    have = np.diff(first)
    whole = prefix_hash(word, first)
    per = np.where(have >= words, have - words + 1, 0)
    doc = np.repeat(np.arange(n), per)
    begin = np.repeat(first[:-1], per) + np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    h = np.zeros(len(begin), np.uint64)
    for j in range(words):
        h += mix(word[begin + j] + _steps(j))
    h = mix(h)
    few = np.flatnonzero((have > 0) & (have < words))
    if len(few):
        doc = np.concatenate((doc, few))
        h = np.concatenate((h, whole[few]))
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    bounds = np.searchsorted(doc, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(new)
    return h[at], np.diff(np.concatenate((at, [len(h)]))), np.searchsorted(at, bounds), whole


def prefix_hash(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the word sequence of each text, never 0 where it has words."""
    sums = np.zeros(len(word) + 1, np.uint64)
    place = np.arange(len(word), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    np.cumsum(mix(word + mix(place)), out=sums[1:])
    out = mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))
    return np.where(np.diff(first) > 0, out | np.uint64(1), np.uint64(0))


# -- document frequencies ------------------------------------------------------

def _heavy(rare: int, run: int, most: int = 2_000_000):
    """The shingles that may be in more than 1 / 2 rare of a task's texts, and by
    how much in units of 1 / 2 rare documents.  A summary goes from run to run and
    loses one unit for each text: half of them as runs come, so that it stays
    small, the rest when the task ends, so that a short last run leaves no more
    behind than others.  Where it still outgrows ``most`` shingles (few long
    texts) it is sent off and a new one begins."""

    def grown(h: np.ndarray, over: np.ndarray, held: list[np.ndarray], units: int) -> tuple[np.ndarray, np.ndarray]:
        new = np.concatenate(held)
        held.clear()
        new.sort()
        at = np.searchsorted(new, h)
        known = np.flatnonzero(at < len(new))
        known = known[new[at[known]] == h[known]]
        over[known] += 2 * rare * (np.searchsorted(new, h[known], "right") - at[known])
        h, over = less(h, over, units)
        # in more than k texts: the one k places on is still the same
        k = units // (2 * rare)
        first = new[: max(0, len(new) - k)]
        new, n = np.unique(first[first == new[k:]], return_counts=True)
        at = np.searchsorted(h, new)
        unknown = np.ones(len(new), bool)
        inside = np.flatnonzero(at < len(h))
        unknown[inside] = h[at[inside]] != new[inside]
        at = at[unknown]
        return np.insert(h, at, new[unknown]), np.insert(over, at, 2 * rare * (n[unknown] + k) - units)

    def less(h: np.ndarray, over: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
        stay = over > units
        return h[stay], over[stay] - units

    def sent(h: np.ndarray, over: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(over)], names=["shingle", "over"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        summary, held, size, docs, taken = none, [], 0, 0, 0
        for b in slices(batches, "text", PIECE):
            h, _, _, _ = shingles(b.column("text"))
            held.append(h)
            size, docs = size + len(h), docs + b.num_rows
            if size < run:
                continue
            half = max(taken, docs // 2)
            summary, size, taken = grown(*summary, held, half - taken), 0, half
            if len(summary[0]) > most:
                summary, taken = less(*summary, docs - taken), docs
            if len(summary[0]) > most:
                yield sent(*summary)
                summary, docs, taken = none, 0, 0
        if docs:
            yield sent(*(grown(*summary, held, docs - taken) if held else less(*summary, docs - taken)))

    return task


def _counter(shared):
    """Documents of a task that hold each candidate shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = shared.value
        table = SliceTable(max(16, len(sought)))
        table.add(sought)
        counts = np.zeros(len(sought), np.int64)
        for b in slices(batches, "text", PIECE):
            at = table.find(shingles(b.column("text"))[0])
            counts += np.bincount(at[at >= 0], minlength=len(sought))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(sought[some].view(np.int64)), pa.array(counts[some])], names=["shingle", "df"])

    return run


class Weights:
    """ICWS weights of shingles: count x idf."""

    def __init__(self, frequent: tuple[np.ndarray, np.ndarray], total: int):
        hashes, df = frequent
        self.table = SliceTable(max(16, len(hashes)))
        self.table.add(hashes)
        floor = max(1.0, total / RARE)
        self.idf = np.append(np.log1p(total / np.maximum(df, floor)), np.log1p(total / floor)).astype(np.float32)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.idf[self.table.find(hashes)] * counts.astype(np.float32)


def weights_of(shared) -> Weights:
    """The weights of a broadcast (frequent shingles, total), built once in a
    worker process."""
    return kept(("near_dedup", shared.value[2]), lambda: Weights(*shared.value[:2]))


def _together(texts: DataFrame, total: int) -> DataFrame:
    """Small partitions as one, without a shuffle; large ones stay as they are."""
    return texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // TEXTS)))


def frequencies(texts: DataFrame, total: int, rare: int = RARE, run: int = 2_000_000, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in more than max(1, total / rare) documents, with their document
    frequency: at most rare x mean distinct shingles of a document.

    A task, which adds up its texts by runs of some ``run`` shingles, leaves out
    only shingles in at most 1 / 2 rare of them, so what the tasks report of a
    sought shingle sums up to more than half the limit: at most twice as many
    shingles as the result may hold.  These are then counted exactly over all
    texts.  A task of fewer than 2 rare texts leaves out nothing, so small
    partitions are read together, as far as all cores stay busy."""
    least = max(2 * rare, 2 * total)  # in units of 1 / 2 rare documents
    heavy = _together(texts, total).mapInArrow(giving_back(_heavy(rare, run, most)), "shingle long, over long").groupBy("shingle").agg(F.sum("over").alias("over"))
    sought = heavy.where(F.col("over") > least - total).select("shingle").toArrow().column("shingle").to_numpy().view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(sought)
    counted = texts.mapInArrow(giving_back(_counter(shared)), "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
    found = counted.where(2 * rare * F.col("df") > least).toArrow()
    return found.column("shingle").to_numpy().view(np.uint64), found.column("df").to_numpy()


# -- sampling ------------------------------------------------------------------

def samples(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """ICWS: for each non-empty document (ascending) and sample, a key of the
    chosen (shingle, level); shape documents x count."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    sizes = np.diff(np.append(starts, len(hashes)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    out = np.zeros((len(starts), count), np.uint64)
    log_w = np.log(weights).astype(np.float32)
    unit, half = np.float32(2.0**-24), np.float32(2.0**-25)
    low24 = np.uint64((1 << 24) - 1)
    for k in range(count):
        one = mix(hashes + _steps(2 * k + 1))
        two = mix(one + _STEP)
        u = [((x >> np.uint64(s)) & low24).astype(np.float32) * unit + half for x in (one, two) for s in (0, 24)]
        beta = (((one >> np.uint64(48)) << np.uint64(8)) | (two >> np.uint64(56))).astype(np.float32) * unit
        r = -np.log(u[0] * u[1])  # Gamma(2, 1)
        c = np.log(-np.log(u[2] * u[3]))  # log of Gamma(2, 1)
        level = np.floor(log_w / r + beta)
        a = c - r * (level - beta + np.float32(1))
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == least[owner])
        doc, first = np.unique(owner[hit], return_index=True)
        at = hit[first]
        out[doc, k] = mix(hashes[at] + level[at].astype(np.int64).astype(np.uint64) * _STEP)
    return out


_SIGNED = "doc_id long, id long, row long, node long, weight double, bands array<long>"


def _signer(shared, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = weights_of(shared)
        for b in slices(batches, "text", PIECE):
            h, n, off, whole = shingles(b.column("text"))
            w = weights.of(h, n)
            some = np.diff(off) > 0
            keys = np.zeros((int(some.sum()), 0), np.uint64)
            if len(h):
                s = samples(h, w, off, bands * rows)
                made = []
                for i in range(bands):
                    key = np.full(len(s), _steps(i + 1))
                    for j in range(rows):
                        key = mix(key ^ s[:, i * rows + j]) + _STEP
                    made.append(key)
                keys = np.stack(made, axis=1)
            sums = np.concatenate(([0.0], np.cumsum(w.astype(np.float64))))
            lists = np.zeros(len(some), np.int64)
            lists[some] = keys.shape[1]
            arrays = [b.column(c) for c in ("doc_id", "id", "row")]
            arrays += [pa.array(whole.view(np.int64), mask=~some), pa.array(sums[off[1:]] - sums[off[:-1]])]
            arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lists))), pa.int32()), pa.array(keys.ravel().view(np.int64))))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "id", "row", "node", "weight", "bands"])

    return run


# -- verification --------------------------------------------------------------

def _vectors(shared):
    """Shingles (their upper 32 bits: two foreign ones agree once in four
    thousand million) and weights, null where all weigh as rare ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = weights_of(shared)
        for b in slices(batches, "text", PIECE):
            h, n, off, _ = shingles(b.column("text"))
            w, short = weights.of(h, n), (h >> np.uint64(32)).astype(np.uint32)
            spans = list(zip(off[:-1].tolist(), off[1:].tolist()))
            heavy = [w[x:y].tobytes() if (w[x:y] != weights.idf[-1]).any() else None for x, y in spans]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([short[x:y].tobytes() for x, y in spans], pa.binary()), pa.array(heavy, pa.binary())], names=["node", "shingles", "weights"])

    return run


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (ascending shingles, weights)."""
    (ha, wa), (hb, wb) = a, b
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    both = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64))
    return both / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - both)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def vector(h: bytes, w: bytes | None, rare: float) -> tuple[np.ndarray, np.ndarray]:
        h = np.frombuffer(h, np.uint32)
        return h, np.frombuffer(w, np.float32) if w is not None else np.full(len(h), rare, np.float32)

    for b in batches:
        kept: tuple = (None, None)
        out = []
        rare = b.column("rare")[0].as_py() if b.num_rows else 0.0
        for i in range(b.num_rows):
            pivot = b.column("b")[i].as_py()
            if kept[0] != pivot:
                kept = (pivot, vector(b.column("sb")[i].as_py(), b.column("wb")[i].as_py(), rare))
            out.append(weighted_jaccard(vector(b.column("sa")[i].as_py(), b.column("wa")[i].as_py(), rare), kept[1]))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def _verify(pairs: DataFrame, vectors: DataFrame, rare: float) -> DataFrame:
    left = vectors.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("weights").alias("wa"))
    right = vectors.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("weights").alias("wb"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "wa", "sb", "wb", F.lit(rare).alias("rare"))
    return staged(met.mapInArrow(giving_back(_compare), "a long, b long, similarity double"), "near-verified")


def _listed(rare: float):
    """One row (shingle, node, mass) for each shingle of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "shingles", 1 << 18):
            size = pc.binary_length(b.column("shingles")).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            short = np.frombuffer(b"".join(b.column("shingles").to_pylist()), np.int32)
            mass = [np.frombuffer(w, np.float32) if w is not None else np.full(n, rare, np.float32) for w, n in zip(b.column("weights").to_pylist(), size.tolist())]
            node = np.repeat(b.column("node").to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(short), pa.array(node), pa.array(np.concatenate(mass).astype(np.float64))], names=["shingle", "node", "mass"])

    return run


def _salt(column: str) -> F.Column:
    return F.pmod(F.xxhash64(column), F.col("salts")).cast("int")


def _parted(listed: DataFrame, rows: int) -> DataFrame:
    """The rows (bucket, node, ...) of buckets of several members, with the
    number of parts of their bucket and their own part: salts, salt."""
    part = max(PART, rows // MOST_PARTED)
    sizes = staged(listed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("salts", F.ceil(F.col("n") / part).cast("int")).drop("n"), "near-sizes")
    # more than ``part`` rows each: at most rows / part <= MOST_PARTED buckets, 12 MB
    large = F.broadcast(sizes.where("salts > 1"))
    marked = listed.join(large, "bucket", "left").withColumn("salts", F.coalesce("salts", F.lit(1))).withColumn("salt", _salt("node"))
    return marked.join(_spread(sizes).select("bucket", "salt"), ["bucket", "salt"], "left_semi")


def _spread(few: DataFrame) -> DataFrame:
    """A copy of each row for each part of its bucket (``salts``, dropped)."""
    return few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _solid(members: DataFrame, vectors: DataFrame, rare: float, similarity: float) -> DataFrame:
    """Members that can reach the threshold, with ``solid``: their weight without
    the shingles that no other of them has.  Counted anew among those that stay
    while a tenth of the nodes leave."""
    left = members.select("node").distinct().count()
    while True:
        held = vectors.join(members.select("node").distinct(), "node", "left_semi")
        alone = held.mapInArrow(giving_back(_listed(rare)), "shingle int, node long, mass double").groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("mass").alias("mass")).where("n = 1")
        lost = staged(alone.groupBy("node").agg(F.sum("mass").alias("lost")), "near-lost")
        solid = members.drop("solid").join(lost, "node", "left").withColumn("solid", F.col("weight") - F.coalesce("lost", F.lit(0.0))).drop("lost")
        solid = solid.where(F.col("solid") >= (similarity - 1e-6) * F.col("weight"))
        several = solid.groupBy("bucket").agg(F.count("*").alias("n"), F.max("salts").alias("salts")).where("n > 1").select("bucket", "salts")
        members = staged(solid.join(_spread(several), ["bucket", "salt"], "left_semi"), "near-solid")
        before, left = left, members.select("node").distinct().count()
        if left > 0.9 * before or not left:
            return members


def _rooted(alive: DataFrame, links: DataFrame, far: float) -> tuple[DataFrame, DataFrame]:
    """Members with the root of their component so far, and the links as stars.
    Of two members with different roots one is outside the largest component of
    their bucket: such members are ``open``.  Buckets of one component have
    nothing left to find, and members of the largest that are too far from all
    open ones leave."""
    found = components(links)
    alive = staged(alive.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "near-rooted")
    parts = alive.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.min("away").alias("near"), F.max("salts").alias("salts")).withColumn("salt", _salt("root"))
    top = parts.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("top"), F.count("*").alias("m"), F.max("salts").alias("salts")).where("m > 1").drop("m")
    nearest = parts.join(_spread(top), ["bucket", "salt"]).where("root != top").groupBy("bucket").agg(F.min("top").alias("top"), F.min("near").alias("nearest"), F.max("salts").alias("salts"))
    alive = alive.join(_spread(nearest), ["bucket", "salt"]).withColumn("open", F.col("root") != F.col("top"))
    alive = alive.where(F.col("open") | ~F.col("exact") | (F.col("away") + far + 1e-6 >= F.col("nearest"))).drop("top", "nearest")
    return staged(alive, "near-alive"), found.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _links(members: DataFrame, vectors: DataFrame, rare: float, similarity: float, per_member: int = 16, tried: int = 16) -> DataFrame:
    """Verified links (a, b) that connect what the pairs of the buckets connect.
    members: bucket, node, weight, solid, bands (all buckets of the node).  Pairs are compared directly once at most
    ``per_member`` of them for each member there was can reach the threshold;
    these are counted when at most ``tried`` times as many are left.  Buckets of
    two or three members (three ordered pairs for each, itself counted) have no
    pivots: their pairs are at most one for each member, and a turn of pivots is
    a dozen jobs, whose threads and plans stay in the driver for a while."""
    far, links = 1 - similarity, None
    total, count = members.count(), 1
    few = max(FEWEST, per_member * total)
    held = ["bucket", "node", "weight", "solid", "bands", "salts", "salt"]
    alive = staged(_parted(members.select(*held[:5]), total), "near-parted").withColumns({"open": F.lit(True), "root": F.col("node"), "away": F.lit(0.0), "exact": F.lit(False)})
    common = F.least("solid", "ps")
    bound = common / (F.col("weight") + F.col("pw") - common)
    close = bound >= similarity - 1e-6
    while True:
        sizes = alive.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("open").cast("long")).alias("u"))
        left = sizes.agg(F.sum(F.col("n") * F.col("u"))).first()[0]
        if not left:
            return links
        if left <= 3 * total or links is not None and left <= tried * few:
            other = alive.where("open").select("bucket", "salts", F.col("node").alias("p"), F.col("weight").alias("pw"), F.col("solid").alias("ps"), F.col("root").alias("pr"), F.col("away").alias("pd"), F.col("exact").alias("pe"), F.col("bands").alias("pb"))
            apart = F.col("exact") & F.col("pe") & (F.abs(F.col("away") - F.col("pd")) > far + 1e-6)
            # a pair is made in the first bucket it shares: where it is missing there, it is settled
            both = F.filter(F.zip_with("bands", "pb", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
            pairs = alive.join(_spread(other), ["bucket", "salt"]).where((F.col("root") != F.col("pr")) & close & ~apart & (F.get(both, 0) == F.col("bucket")))
            if left <= few or pairs.count() <= few:
                pairs = pairs.select(F.greatest("node", "p").alias("a"), F.least("node", "p").alias("b")).distinct()
                found = _verify(pairs, vectors, rare).where(F.col("similarity") >= similarity).select("a", "b")
                return found if links is None else links.unionByName(found)
        # the first open members of a bucket; the very first is its reference
        turn = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
        pivot = alive.where("open").select("bucket", "salts", F.col("node").alias("b"), F.col("weight").alias("pw"), F.col("solid").alias("ps"), F.col("root").alias("pr"), turn.alias("k")).where(F.col("k") <= count)
        pivot = staged(pivot, "near-pivots")
        met = alive.join(_spread(pivot), ["bucket", "salt"]).where((F.col("node") != F.col("b")) & ((F.col("k") == 1) | (F.col("root") != F.col("pr"))) & close)
        sims = _verify(met.select(F.col("node").alias("a"), "b").distinct(), vectors, rare)
        found = sims.where(F.col("similarity") >= similarity).select("a", "b")
        links = found if links is None else links.unionByName(found)
        # pivots have met all members; what is not verified is at least 1 - bound away from the reference
        rest = alive.select(*held).join(pivot.select("bucket", F.col("b").alias("node")), ["bucket", "node"], "left_anti")
        rest = rest.join(_spread(pivot.where("k = 1").select("bucket", "salts", "b", "pw", "ps")), ["bucket", "salt"]).join(sims.withColumnRenamed("a", "node"), ["node", "b"], "left")
        rest = rest.select(*held, F.coalesce(1 - F.col("similarity"), 1 - bound).alias("away"), F.col("similarity").isNotNull().alias("exact"))
        alive, links = _rooted(rest, links, far)
        count *= 8


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node) of the connected components of links
    (a, b): large-star and small-star contraction until nothing changes."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "near-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = staged(small.select("e.*").where("u != v").distinct(), "near-edges")
        # done when every node has one parent and no parent has one itself
        parents = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not parents and not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# -- the whole -------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(0).cast("long")).alias("id"), F.xxhash64(doc.isNull(), text).alias("row"), text.alias("text"))


def small_batches(spark: SparkSession) -> conf_set:
    """Arrow batches of at most ``BATCH_ROWS`` rows for jobs run inside."""
    now = int(spark.conf.get(BATCH_CONF))  # 0 and less: no limit
    return conf_set(spark, {BATCH_CONF: str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS)})


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, group_size, kept, id and row: one row per input row."""
    with small_batches(docs.sparkSession):  # every Python job of it ends in here
        return _classes(docs, similarity, bands, rows, id_col, text_col)


def _classes(docs: DataFrame, similarity: float, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    texts = _keyed(docs, id_col, text_col)
    total = texts.count()
    shared = spark.sparkContext.broadcast((frequencies(texts, total), total, uuid.uuid4().hex))
    rare = float(Weights((np.zeros(0, np.uint64), np.zeros(0, np.int64)), total).idf[-1])
    signed = staged(texts.mapInArrow(giving_back(_signer(shared, bands, rows)), _SIGNED), "near-signed")
    # documents with the same words are one node; its first document stands for it
    nodes = staged(
        signed.where("node is not null").groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "id", "row")).alias("first"),
            F.count("*").alias("copies"), F.max("weight").alias("weight"), F.min("bands").alias("bands"),
        ),
        "near-nodes",
    )
    listed = nodes.select("node", "weight", "bands", F.explode("bands").alias("bucket"))
    members = staged(_parted(listed, nodes.count() * bands), "near-members")
    needed = nodes.join(members.select("node").distinct(), "node", "left_semi").select("first.id", "first.row", "node")
    if (n := members.select("node").distinct().count()) <= 1_000_000:
        needed = F.broadcast(needed)  # three numbers a row: at most 24 MB
    parts = texts.select("id", "row", "text").join(needed, ["id", "row"]).select("node", "text")
    vectors = staged(parts.mapInArrow(giving_back(_vectors(shared)), "node long, shingles binary, weights binary").dropDuplicates(["node"]), "near-vectors")
    links = _links(_solid(members, vectors, rare, similarity), vectors, rare, similarity) if n else None
    if links is None:
        roots = nodes.select("node", F.col("node").alias("root"))
    else:
        found = components(links)
        roots = nodes.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    named = nodes.join(roots, "node").select("node", "root", "first", "copies")
    best = named.groupBy("root").agg(F.min("first").alias("keep"), F.sum("copies").alias("group_size"))
    named = named.select("node", "root").join(best, "root").select("node", "keep", "group_size")
    return signed.join(named, "node", "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("class_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce((F.col("keep.id") == F.col("id")) & (F.col("keep.row") == F.col("row")), F.lit(True)).alias("kept"),
        "id", "row",
    )


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, columns as given."""
    name, row = fresh(docs, "near_id"), fresh(docs, "near_row")
    classes = near_classes(docs, similarity, id_col=id_col, text_col=text_col)
    gone = staged(classes.where("not kept").select(F.col("id").alias(name), F.col("row").alias(row)).distinct(), "near-gone")
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    marked = docs.withColumns({name: F.coalesce(doc, F.lit(0).cast("long")), row: F.xxhash64(doc.isNull(), text)})
    return marked.join(sent_if_few(gone), [name, row], "left_anti").select(*docs.columns)
