"""Phrase collocations of each language by best-first branch and bound.

A phrase of 2 to 4 words with a occurrences (``least`` at least) is cut into a
first part that occurs l times and a rest that occurs r times; its score is the
lowest of floor(2000000 a / (l + r)) over its cuts.  Phrases grow word by word.
A phrase that continues prefix P, f(P) = p, has a <= p and r >= a at the cut
after each shorter prefix Q, so no continuation scores more than
2000000 p / (f(Q) + p): the prefix counts bound all growth beyond P, and the
bound only falls as P grows.  Suffix counts bound phrases that end in P alike.

The frontier is expanded best bound first, in batches: a threshold T is set for
each language so that the ``batch`` best nodes have bounds of T and more, one
pass over the texts counts their continuations to three words, another to four.
Then everything that scores T or more is known, with the longer phrases that
may cover it.  A language is settled once ``top`` phrases of at least T survive
(their last score and all its ties are then known) or nothing is left to
expand; the others go on with ``growth`` times as many nodes.

Words are numbered by 64-bit hashes of (language, word); a check over all
distinct words proves them unique, otherwise another seed is taken, so all
counts are exact.  The sets that a pass asks for reach the tasks as bit
filters of fixed size: a false hit only counts a phrase in vain.

Defined results.  Null text counts as empty, null language as ``und``.  A-Z are
lower-cased, pieces end at ``.,;:!?`` and line breaks (0x0A to 0x0D), words at
blanks and tabs.  A text is cut into windows with the last three words carried
over, so long texts need no more memory than their own size.  Ties go by a, then
by the phrase in UTF-8 byte order.  Repeated rows count as often as they stand.
Other columns are not read.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.llm.shared import mix, runs_inside, slices, staged, string_buffers
from pitwall.plans.joins import bounded_broadcast

#: Bytes of text counted at once in a task.
CHUNK = 4 << 20
#: Bits of a filter that says which phrases a pass asks for (8 MB).
FILTER_BITS = 26
#: Nodes of a language in the first batch, as a multiple of ``top``, and how
#: the batch grows while a language is not settled.
BATCH, GROWTH = 8, 8
#: Frequent words are broadcast up to this many rows (checked).
BROADCAST_WORDS = 200_000
BROADCAST_LANGS = 10_000
ONE = 2_000_000
SEEDS = 16

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- counting inside a task ------------------------------------------------

class BitFilter:
    """A set of 64-bit fingerprints in 2**FILTER_BITS bits, two for each."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << FILTER_BITS) - 1)
        return prints & mask, (prints >> np.uint64(64 - FILTER_BITS)) & mask

    def holds(self, prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), bool)
        for at in self.places(prints):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def fingerprint(hashes: list[np.ndarray]) -> np.ndarray:
    """Of phrases given as one array of word numbers for each place."""
    out = np.full(len(hashes[0]), 0x2545F4914F6CDD1D, np.uint64)
    for h in hashes:
        out = mix(out ^ mix(h.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return out


def _factorized(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(keys)
    return codes, distinct


class Words:
    """Words of some texts: numbers 0, 1, ... of the distinct (language, word)
    pairs in the order of the texts, and which follow each other in a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], seed: int, carried: int = 0):
        kind = _KIND[data]
        inside = kind == 0
        starts, ends, firsts = runs_inside(inside, offsets)
        n = self.n = len(starts)
        breaks = np.concatenate(([0], np.cumsum(kind == 2, dtype=np.int32)))
        self.follows = np.zeros(max(0, n - 1), bool)
        if n > 1:
            self.follows = breaks[starts[1:]] == breaks[ends[:-1]]
            edges = firsts[1:-1]
            edges = edges[(edges > 0) & (edges < n)]
            self.follows[edges - 1] = False
        self.new = starts >= carried  # a phrase counts where its last word is new
        text = _LOWER[data[inside]]
        cuts = np.zeros(n + 1, np.int64)
        np.cumsum(ends - starts, out=cuts[1:])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(text)]).dictionary_encode()
        spelt = column.dictionary.to_pylist()
        lang_codes, lang_names = pd.factorize(np.array(langs, object))
        of_text = np.repeat(lang_codes, np.diff(firsts)).astype(np.int64)
        width = max(1, len(spelt))
        self.at, pairs = _factorized(of_text * width + column.indices.to_numpy(zero_copy_only=False))
        heads = [xxhash.xxh64(x.encode() + b"\x00", seed=seed) for x in lang_names]
        self.langs = [lang_names[p // width] for p in pairs.tolist()]
        self.spelt = [spelt[p % width] for p in pairs.tolist()]
        hashes = []
        for p in pairs.tolist():
            h = heads[p // width].copy()
            h.update(spelt[p % width])
            hashes.append(h.intdigest())
        self.hashes = np.array(hashes, np.uint64).view(np.int64)

    def starts_of(self, k: int, valid: np.ndarray | None = None) -> np.ndarray:
        """Positions where k words of a piece (all valid) begin."""
        n = self.n - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out = self.new[k - 1 :].copy()
        for j in range(k - 1):
            out &= self.follows[j : j + n]
        return np.flatnonzero(out)


def _windows(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Words]:
    for batch in slices(batches, "text", CHUNK):
        langs = ["und" if x is None else x for x in batch.column("lang").to_pylist()]
        data, offsets = string_buffers(batch.column("text"))
        if batch.num_rows > 1 or len(data) <= 2 * CHUNK:
            yield Words(data, offsets, langs, seed)
            continue
        # One long text: windows end between words; the last three words of a
        # window are read again with the next one.
        lo = carried = 0
        while lo < len(data):
            hi = min(len(data), lo + carried + CHUNK)
            if hi < len(data):
                gaps = np.flatnonzero(_KIND[data[lo + carried : hi]])
                if len(gaps):
                    hi = lo + carried + int(gaps[-1]) + 1
                else:
                    step = hi
                    while step < len(data) and not _KIND[data[step : step + CHUNK]].any():
                        step += CHUNK
                    gaps = np.flatnonzero(_KIND[data[step : step + CHUNK]])
                    hi = step + int(gaps[0]) + 1 if len(gaps) else len(data)
            part = data[lo:hi]
            yield Words(part, np.array([0, len(part)], np.int64), langs, seed, carried)
            starts = runs_inside(_KIND[part] == 0, np.array([0, len(part)], np.int64))[0]
            keep = int(starts[-3]) if len(starts) >= 3 else 0
            lo, carried = (len(data), 0) if hi >= len(data) else (lo + keep, len(part) - keep)


def _count_words(seed: int):
    def run(batches):
        for w in _windows(batches, seed):
            counts = np.bincount(w.at[w.new], minlength=len(w.hashes))
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.hashes[at]), pa.array([w.langs[i] for i in at.tolist()], pa.string()), pa.array([w.spelt[i] for i in at.tolist()], pa.binary()).cast(pa.string()), pa.array(counts[at].astype(np.int64))],
                names=["h1", "lang", "word", "a"],
            )

    return run


class _Level:
    """Distinct phrases of k words at given positions of a ``Words``."""

    def __init__(self, n: int, at: np.ndarray, keys: np.ndarray):
        self.code = np.full(n, -1, np.int64)
        codes, self.keys = _factorized(keys)
        self.code[at] = codes


def _grow(w: Words, words_ok: np.ndarray) -> _Level:
    """All two-word phrases of words that may be frequent; carried words too,
    as the start of longer phrases."""
    n = max(0, w.n - 1)
    at = np.flatnonzero(w.follows & words_ok[w.at[:-1]] & words_ok[w.at[1:]]) if n else np.zeros(0, np.int64)
    return _Level(w.n, at, w.at[at] * len(w.hashes) + w.at[at + 1])


def _emit(w: Words, k: int, at: np.ndarray, keys: np.ndarray, before: list[np.ndarray]) -> pa.RecordBatch:
    """Counts of the phrases of k words at ``at``; ``before`` holds the keys of
    the shorter phrases they grew from."""
    at_new = w.new[at + k - 1]
    codes, distinct = _factorized(keys[at_new])
    counts = np.bincount(codes, minlength=len(distinct)).astype(np.int64)
    d, columns, left = len(w.hashes), [], distinct.astype(np.int64)
    for level in [*before[::-1], None]:
        left, last = left // d, left % d
        columns.append(w.hashes[last])
        if level is None:
            columns.append(w.hashes[left])
        else:
            left = level[left]
    # Two-word phrases end the chain: their key holds both words.
    columns = columns[::-1]
    return pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.array(counts)], names=[*[f"h{i + 1}" for i in range(k)], "a"])


def _prints(w: Words, k: int, level: list[np.ndarray]) -> np.ndarray:
    d, columns, left = len(w.hashes), [], level[-1]
    for keys in [*level[:-1][::-1], None]:
        left, last = left // d, left % d
        columns.append(w.hashes[last])
        if keys is None:
            columns.append(w.hashes[left])
        else:
            left = keys[left]
    return fingerprint(columns[::-1])


def _count_pairs(seed: int, frequent):
    def run(batches):
        ok = BitFilter(frequent.value)
        for w in _windows(batches, seed):
            words_ok = ok.holds(fingerprint([w.hashes]))
            pairs = _grow(w, words_ok)
            at = np.flatnonzero(pairs.code >= 0)
            yield _emit(w, 2, at, pairs.keys[pairs.code[at]], [])

    return run


def _count_triples(seed: int, frequent, pairs_known, heads, tails):
    """Three words: the first two in ``heads`` or the last two in ``tails``."""

    def run(batches):
        ok, known, head, tail = (BitFilter(x.value) for x in (frequent, pairs_known, heads, tails))
        for w in _windows(batches, seed):
            pairs = _grow(w, ok.holds(fingerprint([w.hashes])))
            prints = _prints(w, 2, [pairs.keys])
            known_, head_, tail_ = known.holds(prints), head.holds(prints), tail.holds(prints)
            at = np.flatnonzero((pairs.code[:-1] >= 0) & (pairs.code[1:] >= 0)) if w.n else np.zeros(0, np.int64)
            p, s = pairs.code[at], pairs.code[at + 1]
            keep = (head_[p] & known_[s]) | (known_[p] & tail_[s])
            at, p = at[keep], p[keep]
            yield _emit(w, 3, at, p * len(w.hashes) + w.at[at + 2], [pairs.keys])

    return run


def _count_quads(seed: int, frequent, pairs_known, heads, tails, wanted):
    """Four words: the first three in ``heads`` and the last three in ``tails``,
    or either of them in ``wanted`` (its longer phrases are asked for)."""

    def run(batches):
        ok, known, head, tail, want = (BitFilter(x.value) for x in (frequent, pairs_known, heads, tails, wanted))
        for w in _windows(batches, seed):
            pairs = _grow(w, ok.holds(fingerprint([w.hashes])))
            known_ = known.holds(_prints(w, 2, [pairs.keys]))
            both = (pairs.code[:-1] >= 0) & (pairs.code[1:] >= 0) if w.n else np.zeros(0, bool)
            at = np.flatnonzero(both)
            at = at[known_[pairs.code[at]] & known_[pairs.code[at + 1]]]
            triples = _Level(w.n, at, pairs.code[at] * len(w.hashes) + w.at[at + 2])
            prints = _prints(w, 3, [pairs.keys, triples.keys])
            head_, tail_, want_ = head.holds(prints), tail.holds(prints), want.holds(prints)
            at = np.flatnonzero((triples.code[:-1] >= 0) & (triples.code[1:] >= 0)) if w.n else np.zeros(0, np.int64)
            p, s = triples.code[at], triples.code[at + 1]
            keep = (head_[p] & tail_[s]) | want_[p] | want_[s]
            at, p = at[keep], p[keep]
            yield _emit(w, 4, at, p * len(w.hashes) + w.at[at + 3], [pairs.keys, triples.keys])

    return run


# -- the job ---------------------------------------------------------------

def _filter(spark: SparkSession, phrases: DataFrame, k: int):
    """The phrases' bit filter, broadcast: its size is fixed."""

    def bits(batches):
        for batch in batches:
            prints = fingerprint([batch.column(f"h{i + 1}").to_numpy() for i in range(k)])
            places = np.unique(np.concatenate(BitFilter.places(prints)))
            word, first = np.unique(places >> np.uint64(6), return_index=True)
            if len(word):
                ored = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(ored.view(np.int64))], names=["word", "bits"])

    found = phrases.select(*[f"h{i + 1}" for i in range(k)]).mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(words)


def _wide(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def ratio(a, l, r) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)) in decimal arithmetic."""
    return F.call_function("div", _wide(a) * F.lit(ONE), _wide(l) + _wide(r))


def _scored(df: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """score, l and r of the lowest cut, the bound of the phrases that go on
    from here, and that of the phrases that end in this one."""
    best = F.array_min(F.array(*[F.struct(ratio("a", l, r).alias("score"), F.lit(k).alias("cut"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts, 1)]))
    lowest = lambda xs: F.least(*xs) if len(xs) > 1 else xs[0]
    return (
        df.withColumn("best", best)
        .withColumn("bound", lowest([ratio("a", l, "a") for l, _ in cuts]))
        .withColumn("tail_bound", lowest([ratio("a", "a", r) for _, r in cuts]))
        .select(*df.columns, "best.score", "best.l", "best.r", "bound", "tail_bound")
    )


def _summed(counted: DataFrame, k: int, least: int) -> DataFrame:
    # Rows come summed up by chunk; dealing them out first spares every task a
    # second table of all its phrases.
    keys = [f"h{i + 1}" for i in range(k)]
    return counted.repartition(*keys).groupBy(*keys).agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _words(texts: DataFrame) -> tuple[DataFrame, int]:
    """h1, lang, word, a of every distinct word, with a seed that keeps the
    numbers of all (language, word) pairs apart."""
    for seed in range(SEEDS):
        counted = texts.mapInArrow(_count_words(seed), "h1 long, lang string, word string, a long").repartition("h1")
        words = staged(counted.groupBy("h1", "lang", "word").agg(F.sum("a").alias("a")), "collocation-words")
        if words.groupBy("h1").count().where(F.col("count") > 1).isEmpty():
            return words, seed
    raise RuntimeError(f"word numbers clash for {SEEDS} seeds")


def _thresholds(nodes: DataFrame, batch: int) -> DataFrame:
    """lang, t: the highest t at which ``batch`` nodes of the language have
    bounds of t and more; 0 where it has fewer.  A histogram of the bounds
    bounds the window, however many nodes there are."""
    bins = nodes.groupBy("lang", F.expr("bound div 100").alias("bin")).count()
    down = Window.partitionBy("lang").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = bins.withColumn("nodes", F.sum("count").over(down))
    return reached.groupBy("lang").agg((F.coalesce(F.max(F.when(F.col("nodes") >= batch, F.col("bin"))), F.lit(0)) * 100).alias("t"))


def _survivors(short: DataFrame, longer: DataFrame, k: int, cover: int) -> DataFrame:
    """Phrases of k words that no phrase of k + 1 words covers; longer ones
    that do lie in one of these, which occurs as often at least."""
    keys = [f"h{i + 1}" for i in range(k)]
    places = [F.struct(*[F.col(f"h{i + 1 + j}").alias(f"h{i + 1}") for i in range(k)]) for j in range(2)]
    most = longer.select(F.explode(F.array(*places)).alias("p"), F.col("a").alias("longer")).select("p.*", "longer").groupBy(*keys).agg(F.max("longer").alias("longer"))
    covered = _wide("longer") * 100 >= _wide("a") * cover
    return short.join(most, keys, "left").where(F.col("longer").isNull() | ~covered).drop("longer")


def collocations(docs: DataFrame, *, top: int = 2000, least: int = 30, cover: int = 80, text_col: str = "text", lang_col: str = "lang", batch: int = BATCH, growth: int = GROWTH) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top``
    phrases by score and a descending, phrase ascending."""
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    words, seed = _words(texts)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    known = bounded_broadcast(words.where(F.col("a") >= least), BROADCAST_WORDS)
    frequent = _filter(spark, words.where(F.col("a") >= least), 1)

    schema = lambda k: ", ".join([*[f"h{i + 1} long" for i in range(k)], "a long"])
    pairs = _summed(texts.mapInArrow(_count_pairs(seed, frequent), schema(2)), 2, least)
    one, other = known.select("h1", "lang", F.col("a").alias("f1")), known.select(F.col("h1").alias("h2"), F.col("a").alias("f2"))
    pairs = staged(_scored(pairs.join(one, "h1").join(other, "h2").select("lang", "h1", "h2", "a", "f1", "f2"), [("f1", "f2")]), "collocation-pairs")
    pairs_known = _filter(spark, pairs, 2)

    settled, open_langs, nodes = [], pairs.select("lang").distinct(), batch * top
    while True:
        limits = staged(_thresholds(pairs.join(bounded_broadcast(open_langs, BROADCAST_LANGS), "lang", "left_semi"), nodes), "collocation-limits")
        if limits.isEmpty():
            break
        found = _expanded(spark, texts, seed, least, cover, frequent, pairs, pairs_known, limits)
        reached = limits.join(found.groupBy("lang").count(), "lang", "left").select("lang", ((F.coalesce("count", F.lit(0)) >= top) | (F.col("t") == 0)).alias("done"))
        reached = staged(reached, "collocation-reached")
        settled.append(found.join(bounded_broadcast(reached.where("done"), BROADCAST_LANGS), "lang", "left_semi"))
        open_langs, nodes = reached.where(~F.col("done")).select("lang"), nodes * growth
    if not settled:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return _ranked(found, known, totals, top)


def _expanded(spark, texts: DataFrame, seed: int, least: int, cover: int, frequent, pairs: DataFrame, pairs_known, limits: DataFrame) -> DataFrame:
    """All surviving phrases that score t or more, for the languages of ``limits``."""
    schema = lambda k: ", ".join([*[f"h{i + 1} long" for i in range(k)], "a long"])
    limits = bounded_broadcast(limits, BROADCAST_LANGS)
    at_least = lambda df, c: df.where(F.col(c) >= F.col("t"))
    pairs_t = pairs.join(limits, "lang")
    heads, tails = _filter(spark, at_least(pairs_t, "bound"), 2), _filter(spark, at_least(pairs_t, "tail_bound"), 2)
    triples = _summed(texts.mapInArrow(_count_triples(seed, frequent, pairs_known, heads, tails), schema(3)), 3, least)
    first = pairs.select("lang", "h1", "h2", "f1", F.col("a").alias("f12"))
    rest = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
    triples = triples.join(first, ["h1", "h2"]).join(rest, ["h2", "h3"])
    triples = staged(_scored(triples.select("lang", "h1", "h2", "h3", "a", "f1", "f12", "f23", "f3"), [("f1", "f23"), ("f12", "f3")]), "collocation-triples")
    triples_t = triples.join(limits, "lang")
    heads, tails, wanted = (_filter(spark, at_least(triples_t, c), 3) for c in ("bound", "tail_bound", "score"))
    quads = staged(_summed(texts.mapInArrow(_count_quads(seed, frequent, pairs_known, heads, tails, wanted), schema(4)), 4, least), "collocation-quads")
    first = triples.select("lang", "h1", "h2", "h3", "f1", "f12", F.col("a").alias("f123"))
    rest = triples.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("h3").alias("h4"), F.col("a").alias("f234"), F.col("f23").alias("f34"), F.col("f3").alias("f4"))
    scored = quads.join(first, ["h1", "h2", "h3"]).join(rest, ["h2", "h3", "h4"])
    scored = _scored(scored, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])

    result = ["lang", "h1", "h2", "h3", "h4", "a", "l", "r", "score"]
    empty = lambda df, *names: df.withColumns({c: F.lit(None).cast("long") for c in names})
    two = empty(_survivors(at_least(pairs_t, "score"), triples, 2, cover), "h3", "h4")
    three = empty(_survivors(at_least(triples_t, "score"), quads, 3, cover), "h4")
    four = at_least(scored.join(limits, "lang"), "score")
    return staged(two.select(result).unionByName(three.select(result)).unionByName(four.select(result)), "collocation-found")


def _ranked(found: DataFrame, known: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language: those below its ``top``-th score go
    before their words are looked up."""
    scores = found.groupBy("lang", "score").count()
    down = Window.partitionBy("lang").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    last = scores.withColumn("reached", F.sum("count").over(down)).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= top, F.col("score"))), F.lit(0)).alias("last"))
    near = found.join(bounded_broadcast(last, BROADCAST_LANGS), "lang").where(F.col("score") >= F.col("last")).drop("last")
    for i in range(4):
        near = near.join(known.select(F.col("h1").alias(f"h{i + 1}"), F.col("word").alias(f"w{i + 1}")), f"h{i + 1}", "left")
    near = near.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3", "w4"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(bounded_broadcast(totals, BROADCAST_LANGS), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
