"""Each operator against a brute-force version on small tables with nulls,
empty and long texts, ties, repeated rows, clashing extra columns, no rows."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark import AccumulatorParam
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.config import conf_set
from pitwall.llm import bpe, exact_dedup, near_dedup, packing, pii, preference, quality, queries, shared, suffix_dedup, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(parts)


def odd_rows():
    rnd = random.Random(1)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a b"), (4, "ab"), (5, "a  b\x0b"), (5, "a  b\x0b"), (None, "ab"), (None, None), (6, "x" * 40_000), (7, "é😀 ß's 12")]
    rows += [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(1, 120)))) for i in range(8, 60)]
    rows += [(i, rows[20 + i % 5][1]) for i in range(60, 70)]
    return rows


# -- exact dedup ---------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 3])
def test_exact_groups(spark, bits):
    rows = odd_rows()
    got = exact_dedup.exact_groups(table(spark, rows), bits=bits).collect()
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    want = Counter()
    for flat, members in groups.items():
        best = min(members)
        for m in members:
            want[(None if m[1] else m[2], None if best[1] else best[2], len(members), hashlib.sha256(flat.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_dedup_keeps_columns_and_one_row(spark):
    docs = table(spark, odd_rows()).withColumn("dedup_id", F.lit(1)).withColumn("digest", F.lit(2))
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    flats = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(flats) == len(set(flats))
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_stages_move_no_texts_where_few_rows_change(spark, monkeypatch):
    """The tables of what is dropped or masked are counted and sent, whatever
    Spark makes of their size; many of them are left to a shuffle join."""
    rows = odd_rows() + [(i, f"mail a{i}@b{i}.org or none") for i in range(900, 910)]
    docs = table(spark, rows)
    stages = [exact_dedup.exact_dedup, near_dedup.near_dedup, pii.redact]
    monkeypatch.setattr(shared, "FEW_ROWS", 0)
    want = [Counter(map(tuple, s(docs).collect())) for s in stages]
    monkeypatch.undo()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for s, w in zip(stages, want):
            out = s(docs)
            plan = out._jdf.queryExecution().sparkPlan().toString()
            assert "BroadcastHashJoin" in plan and "text" in plan
            if s is not exact_dedup.exact_dedup:  # that has a branch for repeated rows
                assert "SortMergeJoin" not in plan
            assert Counter(map(tuple, out.collect())) == w
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- packing -------------------------------------------------------------------

def test_packing_round_trip(spark):
    rows = odd_rows() + [(90, "token " * 9000)]
    pieces = packing.pack(table(spark, rows), queries.WORD_BPE, capacity=256, batch=4, slack=8).collect()
    t = Tokenizer.from_file(queries.WORD_BPE)
    want = Counter((i, np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, x in rows)
    by_doc: dict = {}
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (i, n), ps in by_doc.items():
        copies = sum(c for (j, ids), c in want.items() if j == i and len(ids) == 4 * n)
        assert sum(p.length for p in ps) == n * copies
    places: dict = {}
    for p in pieces:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in places.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 256
    whole = [p for p in pieces if p.doc_id == 90]
    joined = b"".join(bytes(p.ids) for p in sorted(whole, key=lambda p: p.start))
    assert (90, joined) in want
    assert packing.pack(table(spark, rows).limit(0), queries.WORD_BPE).count() == 0


def test_packing_reads_marks_in_the_text(spark):
    rows = [(1, "end <|endoftext|> next"), (2, "a<|startoftext|>b <|endoftext|><|endoftext|> \x01 c"), (3, "plain words")]
    pieces = packing.pack(table(spark, rows), queries.WORD_BPE, capacity=64).collect()
    t = Tokenizer.from_file(queries.WORD_BPE)
    want = {i: np.array(t.encode(x, add_special_tokens=False).ids + [2], "<u4").tobytes() for i, x in rows}
    assert want[1] == np.array([806, 49407, 1131, 2], "<u4").tobytes()
    assert {p.doc_id: bytes(p.ids) for p in pieces} == want


def test_differencing_is_a_partition():
    rnd = random.Random(2)
    lengths = [rnd.randrange(1, 900) for _ in range(200)]
    windows = packing.differencing(lengths, 16)
    assert sorted(i for w in windows for i in w) == list(range(200))
    sums = [sum(lengths[i] for i in w) for w in windows]
    assert max(sums) - min(sums) < 60


# -- byte-level BPE --------------------------------------------------------------

def test_bpe_equals_library(spark):
    rnd = random.Random(3)
    bits = ["a", "'", "s", "'ll", "re", " ", "  ", "\n", "1", "é", "!", "日", "\x1c", " ", "x"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(14)))) for i in range(600)] + [(1000 + i, t) for i, (_, t) in enumerate(odd_rows())]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_BPE, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = table(spark, rows)
    encoded = bpe.encode(docs, queries.BYTE_BPE)
    want = {i: t or "" for i, t in rows}
    for r in encoded.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(want[r.doc_id]) and r.n_tokens == len(ids)
        assert len(r.offsets) == len(r.ids)
    assert {r.doc_id: r.text for r in bpe.decode(encoded, queries.BYTE_BPE).collect()} == want
    assert bpe.encode(docs.limit(0), queries.BYTE_BPE).count() == 0


# -- suffix-array dedup ------------------------------------------------------------

def spans_by_hand(rows, length):
    seen = Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = Counter()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


@pytest.mark.parametrize("most", [2000, 1])
def test_suffix_dedup(spark, most):
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcde éñ\n") for _ in range(300))
    rows = [(0, None), (1, ""), (2, "a" * 150), (3, "a" * 90 + "b"), (4, "ab" * 80), (None, base), (5, base), (5, base), (6, "zz" + base[:150] + "a" * 70)]
    for i in range(7, 50):
        cut = rnd.randrange(150)
        rows.append((i, "".join(rnd.choice("ab d") for _ in range(rnd.randrange(60))) + base[cut : cut + rnd.randrange(140)] + "".join(rnd.choice("abc") for _ in range(60))))
    docs = table(spark, rows)
    got = suffix_dedup.remove_repeats(docs, 40, 8, most, digest=True).collect()
    assert Counter(tuple(r) for r in got) == spans_by_hand(rows, 40)
    assert suffix_dedup.remove_repeats(docs.limit(0), 40, 8).count() == 0


def test_suffix_dedup_of_repeated_rows_keeps_one_set_of_spans(spark, monkeypatch):
    import pyarrow as pa

    rnd = random.Random(14)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    sent, repeats = [], suffix_dedup._repeats

    def counted(pieces, *rest):
        sent.append(pieces.count())
        return repeats(pieces, *rest)

    def sizes(length, with_text):
        def run(batches):
            for b in batches:
                n = pa.array([len(s or ()) for s in b.column("spans").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, n, n, pa.array([""] * len(n))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return run

    monkeypatch.setattr(suffix_dedup, "_repeats", counted)
    monkeypatch.setattr(suffix_dedup, "_cutter", sizes)
    spans = [{r.n_spans for r in suffix_dedup.remove_repeats(table(spark, [(None, text)] * m), 40, 8, digest=True).collect()} for m in (2, 30)]
    assert spans[0] == spans[1] and len(spans[0]) == 1 and min(spans[0]) > 0
    assert sent[0] == sent[1] > 0


def test_two_stage_sort_is_the_suffix_order():
    rnd = random.Random(5)
    for _ in range(50):
        raw = bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 60)))
        data = np.frombuffer(raw, np.uint8)
        assert suffix_dedup.two_stage_sort(data, np.arange(len(raw)), 100).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


# -- near-dedup ----------------------------------------------------------------------

def classes_by_hand(rows):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
        sets[d] = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])
    df = Counter(s for c in sets.values() for s in c)
    n = len(rows)
    weigh = {d: {s: k * math.log1p(n / max(df[s], n / 1000, 1)) for s, k in c.items()} for d, c in sets.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = sum(min(v, weigh[b][s]) for s, v in weigh[a].items() if s in weigh[b])
            if both and both / (sum(weigh[a].values()) + sum(weigh[b].values()) - both) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_near_classes(spark):
    rnd = random.Random(6)
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One, two!"), (4, "x" * 30_000)]
    for g in range(12):
        words = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(300)]
        for _ in range(5):
            copy = list(words)
            copy[rnd.randrange(300)] = "changed"
            rows.append((len(rows), " ".join(copy)))
    docs = table(spark, rows)
    got = near_dedup.near_classes(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == classes_by_hand(rows)
    kept = near_dedup.near_dedup(docs.withColumn("near_id", F.lit(0)))
    assert kept.count() == len(set(classes_by_hand(rows).values()))
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def test_links_connect_a_chain_within_one_bucket(spark):
    # neighbours reach 90 / 110, all others stay below 0.8; no pivot is near all
    sets = {n: np.arange(10 * n, 10 * n + 100, dtype=np.uint32) for n in range(1, 13)}
    vectors = spark.createDataFrame([(n, bytearray(v.tobytes()), None) for n, v in sets.items()], "node long, shingles binary, weights binary")
    members = spark.createDataFrame([(7, n, 100.0, 100.0, [n, 7]) for n in sets], "bucket long, node long, weight double, solid double, bands array<long>")
    for direct in (0, 16):
        near_dedup.FEWEST, fewest = direct, near_dedup.FEWEST
        try:
            links = near_dedup._links(members, vectors, 1.0, 0.8, per_member=direct)
            roots = {r.node: r.root for r in near_dedup.components(links).collect()}
        finally:
            near_dedup.FEWEST = fewest
        assert roots == {n: 1 for n in range(2, 13)}


def test_links_of_small_buckets_need_no_pivots(spark, monkeypatch):
    """Buckets of two and three: every pair is compared, no turn of pivots runs
    (its jobs leave threads and plans in the driver); a pair in two buckets once."""
    sets = {n: np.arange(10 * n, 10 * n + 100, dtype=np.uint32) for n in (1, 2, 3, 20, 21, 40, 60)}
    vectors = spark.createDataFrame([(n, bytearray(v.tobytes()), None) for n, v in sets.items()], "node long, shingles binary, weights binary")
    held = {1: [7, 101], 2: [7, 102], 3: [7, 103], 20: [8, 9], 21: [8, 9], 40: [140, 5], 60: [160, 5]}
    rows = [(b, n, 100.0, 100.0, bands) for n, bands in held.items() for b in bands if b < 100]
    members = spark.createDataFrame(rows, "bucket long, node long, weight double, solid double, bands array<long>")
    compared = []
    verify = near_dedup._verify
    monkeypatch.setattr(near_dedup, "_verify", lambda pairs, *a: compared.extend(tuple(r) for r in pairs.select("a", "b").collect()) or verify(pairs, *a))
    monkeypatch.setattr(near_dedup, "_rooted", lambda *a: pytest.fail("a turn of pivots"))
    links = near_dedup._links(members, vectors, 1.0, 0.8)
    assert sorted(compared) == [(2, 1), (3, 1), (3, 2), (21, 20), (60, 40)]
    assert sorted(tuple(r) for r in links.collect()) == [(2, 1), (3, 2), (21, 20)]


def test_toxicity_training_gives_memory_back(spark, monkeypatch):
    back = []
    monkeypatch.setattr(toxicity, "give_back", lambda: back.append(1), raising=False)
    docs = table(spark, [(i, "vile words here" if i % 2 else "kind words here") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert back == [1] and len(model.weights) == 1 << toxicity.BITS


@pytest.mark.parametrize("run", [50, 2_000_000])
def test_frequencies_are_exact(spark, run):
    rnd = random.Random(run)
    texts = [" ".join(rnd.choice(WORDS[:3]) for _ in range(rnd.choice([0, 3, 8, 40]))) for _ in range(300)] + ["alpha beta gamma delta " * 50] * 40
    want = Counter(h for t in texts for h in near_dedup.shingles(pa.array([t]))[0].tolist())
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    h, n = near_dedup.frequencies(docs, len(texts), 10, run)
    assert dict(zip(h.tolist(), n.tolist())) == {k: v for k, v in want.items() if v > len(texts) / 10}
    assert len(h) and len(near_dedup.frequencies(docs.limit(0), 0)[0]) == 0


def test_workers_give_freed_memory_back(monkeypatch):
    """What a task freed below something that stays leaves the process when the
    task ends; also when it is not read to its end."""
    def held() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        for b in batches:
            blocks = []
            for i in range(3000):
                blocks.append(b"x" * (50_000 + i))
                pins.append(b"x" * (2000 + i))
            del blocks
            sizes.append(held())
            yield b

    sizes, pins, called = [], [], []
    batch = pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])
    assert list(shared.giving_back(run)(iter([batch, batch]))) == [batch, batch]
    assert held() < sizes[-1] - (100 << 20)
    monkeypatch.setattr(shared, "give_back", lambda: called.append(1))
    half = shared.giving_back(run)(iter([batch, batch]))
    next(half)
    half.close()
    assert called == [1]


def test_packing_encodes_few_texts_at_once(spark, monkeypatch):
    """Texts of a batch are taken in pieces; the pieces don't change the result."""
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("some words here "), F.col("id").cast("string"), F.lit(" ")), 20).alias("text"))
    got = {}
    for piece in (1 << 14, 1 << 30):
        monkeypatch.setattr(packing, "PIECE", piece)
        packed = packing.pack(docs, queries.WORD_BPE)
        got[piece] = sorted(tuple(r) for r in packed.collect())
    assert got[1 << 14] == got[1 << 30] and len(got[1 << 14]) >= 300


class Most(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, a, b):
        return max(a, b)


def test_heavy_shingles_of_a_run_take_little_memory(monkeypatch):
    """A run whose shingles mostly occur once: beside its list no second one."""
    rng, size = np.random.default_rng(3), 1 << 20
    often = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    held = np.concatenate((rng.integers(1, 1 << 62, size - 1200).astype(np.uint64), np.repeat(often, 3)))
    monkeypatch.setattr(near_dedup, "shingles", lambda column: (held, None, None, None))
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 4000)], names=["text"])
    tracemalloc.start()
    try:
        (got,) = near_dedup._heavy(1000, size)(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * held.nbytes
    want = Counter({int(h): 2 * 1000 * n - 4000 for h, n in Counter(held.tolist()).items() if 2 * 1000 * n > 4000})
    assert dict(zip(got.column("shingle").to_numpy().view(np.uint64).tolist(), got.column("over").to_pylist())) == want


@pytest.mark.parametrize("docs, runs", [(1, [[5]]), (30, [[5]]), (7, [[1, 2, 2], [2, 3]]), (40, [[1, 2, 2], [2, 3, 3], [3, 3]]), (9, [[]])])
def test_heavy_shingles_of_small_runs(monkeypatch, docs, runs):
    lists = iter([np.array(r, np.uint64) for r in runs])
    monkeypatch.setattr(near_dedup, "shingles", lambda column: (next(lists), None, None, None))
    sizes = [docs - len(runs) + 1] + [1] * (len(runs) - 1)
    batches = [pa.RecordBatch.from_arrays([pa.array(["x"] * n)], names=["text"]) for n in sizes]
    (got,) = near_dedup._heavy(5, 100)(iter(batches))
    want = {h: 10 * n - docs for h, n in Counter(sum(runs, [])).items() if 10 * n > docs}
    assert dict(zip(got.column("shingle").to_pylist(), got.column("over").to_pylist())) == want


def heavy_of(lists, docs_of, rare, run, most, monkeypatch):
    """Rows that a task sends for given shingles of its batches, and their sums."""
    given = iter(lists)
    monkeypatch.setattr(near_dedup, "shingles", lambda column: (next(given), None, None, None))
    batches = [pa.RecordBatch.from_arrays([pa.array([""] * n)], names=["text"]) for n in docs_of]
    sums: Counter = Counter()
    rows = 0
    for b in near_dedup._heavy(rare, run, most)(iter(batches)):
        rows += b.num_rows
        for h, n in zip(b.column("shingle").to_pylist(), b.column("over").to_pylist()):
            sums[h] += n
    return rows, sums


def test_heavy_shingles_of_a_short_last_run(monkeypatch):
    """What a task sends does not depend on where its last run ends."""
    for docs in (100, 110, 119, 125):
        lists = [np.array([7, *range(1000 + 9 * i, 1009 + 9 * i)], np.uint64) for i in range(docs)]
        rows, sums = heavy_of(lists, [1] * docs, 10, 250, 1 << 20, monkeypatch)
        assert (rows, dict(sums)) == (1, {7: 20 * docs - docs})


@pytest.mark.parametrize("run, most", [(1, 1 << 20), (60, 1 << 20), (60, 30), (200, 3), (1 << 20, 1)])
def test_heavy_shingles_sum_up(monkeypatch, run, most):
    """However texts are cut into runs and summaries: of each shingle at most 1
    of 2 rare documents is left out, and nothing is added."""
    rnd = random.Random(run + most)
    docs_of = [rnd.choice([1, 1, 2, 5]) for _ in range(120)]
    lists = [np.array(sorted(h for _ in range(n) for h in {int(rnd.expovariate(0.05)) for _ in range(12)}), np.uint64) for n in docs_of]
    _, sums = heavy_of(lists, docs_of, 5, run, most, monkeypatch)
    for h, n in Counter(np.concatenate(lists).tolist()).items():
        assert 10 * n - sum(docs_of) <= sums[h] <= 10 * n


def test_workers_keep_one_operators_tables(monkeypatch):
    """A worker that packed texts lets the tokenizer go when it scores others."""
    monkeypatch.setattr(shared, "_KEPT", {})
    words = packing.word_ids(queries.WORD_BPE, 2)
    assert packing.word_ids(queries.WORD_BPE, 2) is words
    weights = shared.kept(("near_dedup", "a"), lambda: [1])
    assert shared.kept(("near_dedup", "a"), lambda: [2]) is weights and len(shared._KEPT) == 1
    assert packing.word_ids(queries.WORD_BPE, 2) is not words


@pytest.mark.parametrize("piece", [1 << 4, 1 << 11, 1 << 30])
def test_toxicity_scores_few_texts_at_once(monkeypatch, piece):
    """The pieces in which texts are scored don't change a score."""
    rnd = random.Random(4)
    column = pa.array([None, "", *(" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(300))) for _ in range(40))])
    weights = np.random.default_rng(4).normal(size=1 << toxicity.BITS).astype(np.float32)
    monkeypatch.setattr(toxicity, "SCORED", piece)
    want = [math.fsum([0.5, *weights[np.unique(toxicity.grams(column[i : i + 1])[0])].astype(float)]) for i in range(len(column))]
    assert np.allclose(toxicity.Model(weights, 0.5).margin(column), want, rtol=0, atol=1e-9)


def test_near_classes_reads_small_batches(spark, monkeypatch):
    """Every job of texts gets them in batches of few rows; the setting is put back."""
    most, before = spark.sparkContext.accumulator(0, Most()), spark.conf.get(near_dedup.BATCH_CONF)
    signer = near_dedup._signer

    def watched(*given):
        run = signer(*given)

        def noting(batches):
            for b in batches:
                most.add(b.num_rows)
                yield from run(iter([b]))

        return noting

    monkeypatch.setattr(near_dedup, "_signer", watched)
    docs = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(w) for w in "a b c d e".split()], F.col("id").cast("string")).alias("text"))
    assert near_dedup.near_classes(docs).count() == 2500
    assert 0 < most.value <= near_dedup.BATCH_ROWS
    assert spark.conf.get(near_dedup.BATCH_CONF) == before
    with conf_set(spark, {near_dedup.BATCH_CONF: "0"}), near_dedup.small_batches(spark):
        assert spark.conf.get(near_dedup.BATCH_CONF) == str(near_dedup.BATCH_ROWS)


def test_small_partitions_are_read_together_for_heavy_shingles(spark):
    cores = spark.sparkContext.defaultParallelism
    texts = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(40 * cores)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(20 * cores)
    heavy = near_dedup._together(docs, len(texts)).mapInArrow(near_dedup._heavy(10, 1 << 30), "shingle long, over long")
    # 2 texts of a partition of their own make every shingle heavy; here 40 meet
    assert heavy.count() < len(texts)
    assert near_dedup._together(docs, 10**9).rdd.getNumPartitions() == 20 * cores


def test_buckets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART", 2)
    monkeypatch.setattr(near_dedup, "FEWEST", 0)
    listed = spark.createDataFrame([(b, n) for b, size in ((1, 1), (2, 2), (3, 40)) for n in range(size)], "bucket long, node long")
    parted = near_dedup._parted(listed, 43).collect()
    assert Counter(r.bucket for r in parted) == {2: 2, 3: 40}
    assert {(r.bucket, r.salts) for r in parted} == {(2, 1), (3, 20)}
    assert all(0 <= r.salt < r.salts for r in parted) and len({r.salt for r in parted if r.bucket == 3}) > 10
    few = spark.createDataFrame([(2, 1), (3, 20)], "bucket long, salts int")
    assert sorted(tuple(r) for r in near_dedup._spread(few).collect()) == [(2, 0)] + [(3, k) for k in range(20)]
    # a hot bucket: two classes whose members share passages, all in one bucket of the sampling
    rnd = random.Random(9)
    rows, long = [], [rnd.choice(WORDS) + str(rnd.randrange(900)) for _ in range(600)]
    for g in range(2):
        words = long[:300] + [f"{g}{w}" for w in long[300:]]
        for _ in range(30):
            copy = list(words)
            copy[rnd.randrange(600)] = f"changed{len(rows)}"
            rows.append((len(rows), " ".join(copy)))
    got = near_dedup.near_classes(table(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == classes_by_hand(rows)


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(7)
    h = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    h.sort()
    w = rng.uniform(0.5, 6, 400).astype(np.float32)
    a, b = np.arange(400) < 330, np.arange(400) >= 60
    both = float(w[a & b].sum() / w.sum())
    keys = [near_dedup.samples(h[m], w[m], np.array([0, m.sum()]), 800)[0] for m in (a, b)]
    assert abs((keys[0] == keys[1]).mean() - both) < 0.06


# -- PII --------------------------------------------------------------------------------

def test_base_spans_and_discovery(spark):
    rnd = random.Random(8)
    bits = ["a", "1", "4", ".", "@", "-", " ", "+", "(", "_", "255", "300", "4111 1111 1111 1111", "+1 (486) 555-3535", "é", "😀", "a@b.co"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(40)))) for i in range(800)] + [(900, None), (901, ""), (902, "1" * 20_000), (903, "a" * 20_000 + "@"), (903, "a" * 20_000 + "@")]
    rows += [(1000 + i, f"hello call me at +1 (486) 555-35{i:02d} thanks") for i in range(20)] + [(2000, "now call me at 486.555.3599 ok")]

    def base(t):
        out = []
        forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
        for rank, (kind, form) in enumerate(forms.items()):
            for m in re.finditer(form, t or "") if len(t or "") < 10_000 else ():
                d = re.sub("[^0-9]", "", m[0])
                luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
                if {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                    out.append((m.start(), rank, m.end()))
        return sorted(out)

    docs = table(spark, rows)
    got = pii.pii(docs).collect()
    assert Counter((r.doc_id, tuple((s.start, s.rank, s.end) for s in r.spans if s.base)) for r in got) == Counter((i, tuple(base(t))) for i, t in rows)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in got}
    assert found[2000] == [("phone", 15, 27)]
    masked = {r.doc_id: r.text for r in pii.redact(docs.withColumn("pii_id", F.lit(0))).collect()}
    assert masked[2000] == "now call me at [PHONE] ok" and masked[1003] == "hello call me at [PHONE] thanks" and masked[900] is None
    assert pii.pii(docs.limit(0)).count() == 0


def test_discovery_of_identifiers_with_blanks(spark):
    rows = [(i, f"hello call me at +1 (486) 555-35{i:02d} thanks") for i in range(20)]
    rows += [(30, "now call me at (486) 555-3535 ok"), (31, "now call me at 486 555 3535, ok"), (32, "now call me at 4111 2222 3333 4445 ok"), (33, "now call me at 486.555.3599 ok 1999, 2000")]
    docs = table(spark, rows)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.pii(docs).collect()}
    assert {i: s for i, s in found.items() if s} == {30: [("phone", 15, 29)], 31: [("phone", 15, 27)], 32: [("phone", 15, 34)], 33: [("phone", 15, 27)]}
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[30] == "now call me at [PHONE] ok" and masked[31] == "now call me at [PHONE], ok"


def test_discovery_between_words(spark):
    long = "w" * 100
    rows = [(i, f"word{i} at +1 (486) 555-35{i:02d} {long} end") for i in range(20)]
    rows += [(30, f"other at 486.555.3599 {long}"), (31, f"more at (486) 555-3598 {long} 7"), (32, f"none at 486.555.3597 {long[1:]}")]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.pii(table(spark, rows)).collect()}
    assert {i: s for i, s in found.items() if s} == {30: [("phone", 9, 21)], 31: [("phone", 8, 22)]}


def test_secrets_and_what_their_patterns_find(spark):
    rows = [(i, f"word{i} token = \"{i:04x}f3ef4d6b2755a36d7d{i:02d}\" and on") for i in range(8)]
    rows += [(20, 'now TOKEN = "9233A8ECF7C5B09FE59" end'), (21, "so token = 77aa31 ok"), (22, 'a token = "abcdefghijklmnopqrstuvw" none'), (23, 'mytoken_9 = "0123456789abcdef0" x'), (24, 'secret: \'k3y-of_16/chars+\' a@b.co')]
    docs = table(spark, rows)
    got = {r.doc_id: [(s.kind, s.base, rows_text[s.start : s.end]) for s in r.spans] for r in pii.pii(docs).collect() for rows_text in [dict(rows)[r.doc_id]]}
    for i in range(8):
        assert got[i] == [("secret", False, f"{i:04x}f3ef4d6b2755a36d7d{i:02d}")]
    assert got[20] == [("secret", False, "9233A8ECF7C5B09FE59")]  # found by the pattern "token ="
    assert got[21] == [("secret", False, "77aa31")]  # without quotes no seed
    assert got[22] == [] and got[23] == []
    assert got[24] == [("secret", False, "k3y-of_16/chars+"), ("email", True, "a@b.co")]
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[20] == 'now TOKEN = "[SECRET]" end'


@pytest.mark.parametrize("seed", range(3))
def test_pattern_graph_by_force(spark, seed):
    """The turns of scoring against dictionaries, on random graphs."""
    rnd = random.Random(seed)
    kinds = {f"i{n}": rnd.choice(["phone", "ip", "secret"]) for n in range(25)}
    edges = {(f"p{rnd.randrange(12)}", f"i{rnd.randrange(60)}") for _ in range(220)}
    edges = sorted({(p, i, kinds.get(i)) for p, i in edges})
    known = {(i, k): 1.0 for _, i, k in edges if k}
    sizes = Counter(p for p, _ in {(p, i) for p, i, _ in edges})
    want: dict = {}
    for turn in range(3):
        sums: dict = {}
        for p, i in {(p, i) for p, i, _ in edges}:
            for (j, k), v in known.items():
                if i == j:
                    total, n = sums.get((p, k), (0.0, 0))
                    sums[p, k] = (total + v, n + 1)
        want = {key: (total / (sizes[key[0]] + 1), n) for key, (total, n) in sums.items()}
        new: dict = {}
        for p, i, k0 in edges:
            if k0 is None:
                for (q, k), (v, n) in want.items():
                    if q == p and v >= 0.15 and n >= 3:
                        new[i, k] = new.get((i, k), 1.0) * (1 - min(v, 0.999))
        known = {(i, k): 1.0 for _, i, k in edges if k} | {key: 1 - v for key, v in new.items()}
    got = pii.score_patterns(spark.createDataFrame(edges, "pattern string, instance string, kind string"), trust=0.15).collect()
    assert {(r.pattern, r.kind): r.support for r in got} == {key: n for key, (_, n) in want.items()}
    assert all(abs(r.score - want[r.pattern, r.kind][0]) < 1e-9 for r in got)
    assert new  # instances beyond the seeds took part


# -- top-k --------------------------------------------------------------------------------

def best_by_force(rows, k=20):
    """(query, rank, id, score) with repeated rows as rows of their own."""
    q = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want, most = Counter(), (1 << 63) - 1
    for n, i, v in q:
        if i is not None and i % 20 == 0:
            scores = sorted(((-max(-most, min(most, sum(a * b for a, b in zip(v, w)))), j is None, j or 0) for m, j, w in q if m != n))[:k]
            want.update((i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scores, 1))
    return want


def test_top_k(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 420)]
    rows += [(500, None), (520, [None] * 8), (540, [float("nan")] * 8), (560, []), (None, [0.6] * 8), (504, [0.9] * 4), (7, rows[7][1])]
    rows += [(20, rows[20][1]), (20, [0.7] * 8), (None, [0.5] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("row", F.lit("x"))
    want = best_by_force(rows)
    for size in (1 << 24, 30 * 64):
        got = topk.top_k(vectors, F.col("vec_id") % 20 == 0, block_bytes=size).collect()
        assert Counter(map(tuple, got)) == want
    assert (560, 20) in {(q, r) for q, r, _, s in want if s == 0}  # an empty vector asks too
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    empty = spark.createDataFrame([(20, []), (20, []), (1, [])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(empty, F.col("vec_id") % 20 == 0).collect())) == [(20, 1, 1, 0), (20, 1, 1, 0), (20, 2, 20, 0), (20, 2, 20, 0)]


def test_top_k_of_large_components(spark):
    rnd = random.Random(13)
    rows = [(i, [float(rnd.randrange(-9, 9)) for _ in range(4)]) for i in range(40)]
    rows += [(40, [2.0**21, -1.0, 0.5, 3.0]), (41, [-(2.0**24) - 1, 2.0**20, 1.0, 0.0]), (42, [2.0**20, 2.0**20, -7.0, 1.0]), (60, [1.0, 2.0**22 + 1, 0.0, -1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size in (1 << 24, 5 * 32):
        assert Counter(map(tuple, topk.top_k(vectors, F.col("vec_id") % 20 == 0, block_bytes=size).collect())) == best_by_force(rows)


def test_top_k_goes_on_beyond_64_bits(spark):
    """A huge component spoils no other row's result."""
    rows = [(i, [float(i % 5), 1.0]) for i in range(30)] + [(100, [1e30, 1.0]), (101, [-1e30, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert Counter(map(tuple, got)) == best_by_force(rows)


# -- classifiers ------------------------------------------------------------------------------

@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_learn_and_hold_out(spark, module, label):
    rnd = random.Random(10)
    rows, marks = [], []
    for i in range(900):
        words = [rnd.choice(WORDS) for _ in range(40)]
        bad = i % 3 == 0
        if bad:
            words[5:8] = ["stupid", "loser", "scum"] if label == "toxic" else ["%%%", "###", "|||"]
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad) if label == "toxic" else int(not bad)))
    rows += [(2000, None), (2001, ""), (None, "alpha"), (3, rows[3][1])]
    marks += [(None, 1), (5000, None)]
    docs = table(spark, rows)
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int")
    model = module.train(docs, labels)
    got = module.score(docs.withColumn("score", F.lit("x")), model, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    y = dict(m for m in marks if m[0] is not None)
    held = [r for r in got if r.doc_id in y and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100 and sum(r.predicted == y[r.doc_id] for r in held) / len(held) > 0.97
    assert module.score(docs.limit(0), model, ["doc_id"]).count() == 0
    none = module.train(docs, labels.limit(0))
    assert {r.predicted for r in module.score(docs, none, ["doc_id"]).collect()} == {0}


def test_grams_are_of_characters():
    import pyarrow as pa

    bucket, owner = toxicity.grams(pa.array(["жук", "", None, "é", "abc"]))
    # with a blank on each side: 5, 2, 2, 3 and 5 characters
    assert Counter(owner.tolist()) == {0: 3 + 2 + 1, 3: 1, 4: 3 + 2 + 1}
    assert len(set(bucket.tolist())) == 13


def test_toxicity_by_force():
    """Ratios and margins against sets of n-grams in plain Python, and long
    texts read in pieces."""
    import pyarrow as pa

    rnd = random.Random(14)
    texts = [" ".join(rnd.choice(WORDS + ["Жук", "é"]) for _ in range(30)) + (" vile scum" if i % 4 == 0 else "") for i in range(120)] + [None, ""]
    labels = np.array([int(i % 4 == 0) for i in range(120)] + [0, 0])
    column = pa.array(texts)

    def plain(text):
        t = f" {(text or '').lower()} "
        return {t[i : i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)}

    sets = [plain(t) for t in texts]
    number = {g: int(toxicity._rolled(pa.array([g], pa.large_string()))[0][-1]) for g in set().union(*sets)}  # its longest n-gram comes last
    want = sorted({(i << toxicity.BITS) | number[g] for i, s in enumerate(sets) for g in s})
    pairs = toxicity.distinct_grams(column)
    assert pairs.tolist() == want
    for piece in (7, 50):
        assert toxicity.distinct_grams(column, piece=piece).tolist() == want
    ratio = toxicity.ratios(pairs >> toxicity.BITS, pairs & ((1 << toxicity.BITS) - 1), labels)
    by_bucket = {}
    for i, s in enumerate(sets):
        for b in {number[g] for g in s}:
            by_bucket.setdefault(b, [0, 0])[labels[i]] += 1
    n0, n1 = int((labels == 0).sum()), int((labels == 1).sum())
    common = {int(b) for b in toxicity.common_grams(column)[1]}
    assert common == {b for b, (q, p) in by_bucket.items() if p + q >= 5}
    kept = 0
    for b, (q, p) in by_bucket.items():
        r = math.log((p + 1) / (n1 + 2)) - math.log((q + 1) / (n0 + 2))
        error = math.sqrt(1 / (p + 1) - 1 / (n1 + 2) + 1 / (q + 1) - 1 / (n0 + 2))
        r = 0 if abs(r) < 3.5 * error or p + q < 5 else r
        kept += r != 0
        assert abs(ratio[b] - r) < 1e-9
    assert kept and np.count_nonzero(ratio) == kept
    model = toxicity.fit_calibrated(column, labels, 0.25)
    got = model.score(column)
    for s, score in zip(sets, got):
        z = model.intercept + sum(float(model.weights[b]) for b in {number[g] for g in s})
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-6
    assert ((got >= 0.5) == (labels == 1)).all()


def test_telling_grams_are_those_of_any_fit():
    rnd = random.Random(16)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(20)) + (" vile scum" if i % 4 == 0 else "") for i in range(90)] + [None]
    labels, part, column = np.array([int(i % 4 == 0) for i in range(90)] + [0]), np.arange(91) % 3, pa.array(texts)
    pairs = toxicity.distinct_grams(column)
    text, bucket = pairs >> toxicity.BITS, pairs & ((1 << toxicity.BITS) - 1)
    want = toxicity.ratios(text, bucket, labels) != 0
    for k in range(3):
        held = part[text] != k
        want |= toxicity.ratios((np.cumsum(part != k) - 1)[text[held]], bucket[held], labels[part != k]) != 0
    got = toxicity.telling_grams(column, labels, part, 3)
    assert want.any() and list(zip(*map(np.ndarray.tolist, got))) == list(zip(text[want[bucket]].tolist(), bucket[want[bucket]].tolist()))


def test_calibration_recovers_odds():
    """Margins of half the slope and a sample of equal halves: the true share
    and slope come back; uninformative margins give the share alone."""
    rng = np.random.default_rng(15)
    z = rng.normal(-2, 2, 40_000)
    y = (rng.random(40_000) < 1 / (1 + np.exp(-z))).astype(int)
    few = np.concatenate([rng.choice(np.flatnonzero(y == v), 6_000, replace=False) for v in (0, 1)])
    slope, shift = toxicity.calibration(z[few] / 2 + 3, y[few], y.mean())
    assert abs(slope - 2) < 0.15 and abs(shift + 6) < 0.5
    slope, shift = toxicity.calibration(np.zeros(400), np.arange(400) % 2, 0.1)
    assert abs(1 / (1 + math.exp(-shift)) - 0.1) < 0.02
    slope, shift = toxicity.calibration(np.array([-1.0] * 20 + [1.0] * 20), np.repeat([0, 1], 20), 0.5)
    assert slope > 1 and math.isfinite(slope)  # separable margins stay finite


def test_training_sample_is_bounded_by_rows_and_bytes(spark):
    from pitwall.llm import classify

    rows = [(i, "ab " * (100_000 if i == 7 else 10)) for i in range(300)] + [(8, "longer " * 9), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    fold = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    assert 7 in fold
    got = classify.training_sample(table(spark, rows), labels, "toxic").to_pylist()
    assert sorted(r["__id"] for r in got) == fold  # the long text takes part, whole
    assert {r["__label"] for r in got if r["__id"] == 7} == {1} and max(len(r["text"]) for r in got) == 300_000
    few = classify.training_sample(table(spark, rows), labels, "toxic", most_rows=40).to_pylist()
    assert Counter(r["__label"] for r in few) == {0: 20, 1: 20}
    small = classify.training_sample(table(spark, rows), labels, "toxic", most_bytes=1200).to_pylist()
    for v in (0, 1):
        sizes = sorted(len(r["text"]) for r in small if r["__label"] == v)
        assert 0 < sum(sizes[:-1]) < 600 + 63


def test_factorisation_identity():
    rng = np.random.default_rng(11)
    import pyarrow as pa

    f = quality.features(pa.array(["one two three two", "", None, "x | y"]))
    m = quality.Model(0.1, rng.normal(size=1 << quality.BITS), rng.normal(size=(1 << quality.BITS, quality.RANK)), rng.normal(size=quality.STATISTICS), rng.normal(size=(quality.STATISTICS, quality.RANK)), np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    fast = m.parts(f)[0]
    for t in range(4):
        w = f.owner == t
        x = np.concatenate((f.value[w], f.dense[t]))
        v = np.concatenate((m.word_v[f.word[w]], m.dense_v))
        slow = m.bias + f.value[w] @ m.word_w[f.word[w]] + f.dense[t] @ m.dense_w
        slow += sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert abs(slow - fast[t]) < 1e-8


# -- preference pairs ---------------------------------------------------------------------------

def test_preference_pairs(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "bye"),
        (1, 0, "system", None), (1, 1, None, "q"), (1, 2, "assistant", "no"), (1, 2, "assistant", "no"),
        (2, 0, "user", "alone"), (3, 0, "assistant", "x"), (None, 0, "assistant", "y"),
        (4, None, "assistant", "same"), (4, 1, "user", "after"), (5, 0, "assistant", "same"), (9, 0, "assistant", "no partner"), (9, 1, "user", "\U0001f600"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1))
    paired = preference.pairs(turns)
    got = {r.pair_id: r for r in preference.format_pairs(paired).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 9}
    a = got[0]
    assert (a.prompt_turns, a.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert (a.chosen, a.rejected) == ("<|assistant|>\nyes<|end|>\n<|user|>\nbye<|end|>\n", "<|assistant|>\nno<|end|>\n")
    assert [a.chosen[s.start : s.end] for s in a.chosen_mask] == ["yes<|end|>\n"] and [a.rejected[s.start : s.end] for s in a.rejected_mask] == ["no<|end|>\n"]
    assert got[1].prompt.startswith("<|system|>\n<|end|>\n<|unknown|>\nq<|end|>\n") and got[1].prompt_turns == 3
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == ("<|user|>\nalone<|end|>\n", "", "")  # no reply: all prompt
    assert (got[3].prompt, got[3].chosen, got[3].rejected) == ("", "<|assistant|>\nx<|end|>\n", "")  # its partner has none
    assert (got[4].prompt_turns, got[4].chosen, got[4].chosen_mask, got[4].rejected) == (1, "<|user|>\nafter<|end|>\n", [], "")
    assert got[9].chosen == "<|assistant|>\nno partner<|end|>\n<|user|>\n\U0001f600<|end|>\n" and got[9].rejected == ""
    for r in paired.collect():  # every turn is in the prompt or in a completion
        whole = "".join(f"<|{t.role}|>\n{t.text}<|end|>\n" for t in r.chosen)
        assert got[r.pair_id].prompt + got[r.pair_id].chosen == whole
    assert preference.format_pairs(preference.pairs(turns.limit(0))).count() == 0


def test_masks_of_a_long_conversation(spark):
    turns = spark.range(20_000).select(
        F.lit(8).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.concat(F.lit("t"), "id").alias("text")
    )
    whole = preference.conversations(turns).select(F.lit(1).alias("pair_id"), F.col("turns").alias("chosen"), F.slice("turns", 1, 0).alias("rejected"))
    r = preference.format_pairs(whole).first()
    assert r.prompt == "" and len(r.chosen_mask) == 10_000
    assert all(r.chosen[s.start : s.end] == f"t{2 * i + 1}<|end|>\n" for i, s in enumerate(r.chosen_mask))


# -- pipeline --------------------------------------------------------------------------------------

def test_pipeline_on_a_fixture(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    rows, marks = [], []
    for i in range(200):
        words = [rnd.choice(WORDS) + str(rnd.randrange(30)) for _ in range(60)]
        if i % 4 == 0:
            words[5:8] = ["stupid", "loser", "scum"]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 4 == 0)))
    rows += [(300, rows[1][1] + " \n"), (301, " ".join(["other", *rows[2][1].split()[1:]])), (302, "write to someone@example.org today"), (303, None), (304, "")]
    d = str(tmp_path)
    docs = table(spark, rows).withColumn("predicted", F.lit(9))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    clean = stages["toxicity"](spark, docs, d)
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    assert not [i for i in left if i < 200 and i % 4 == 0] and {i for i in range(200) if i % 4} <= left
    once = stages["exact_dedup"](spark, docs, d)
    ids = {r.doc_id for r in once.collect()}
    assert 1 not in ids and 300 in ids and len(ids & {303, 304}) == 1
    near = stages["near_dedup"](spark, once, d)
    ids = {r.doc_id for r in near.collect()}
    assert 2 in ids and 301 not in ids
    assert {r.text for r in stages["pii"](spark, docs, d).where("doc_id = 302").collect()} == {"write to [EMAIL] today"}
    packed = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in packed} <= left | {300} and {r.doc_id for r in packed} >= {302, 300}
