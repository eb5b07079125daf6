"""Hard negatives, collocations and page extraction against brute force on
small tables with nulls, empty and long texts, ties, repeated rows, clashing
extra columns, no rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitwall.llm import collocations, hard_negatives, html_extract

# -- hard negatives --------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, row string, score double, anchor int"


def mined_by_force(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    usable = [
        (n, i, lab, [math.floor(x * scale) for x in v])
        for n, (i, v, lab) in enumerate(rows)
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = Counter()
    for n, i, lab, v in usable:
        if not is_anchor(i):
            continue
        same = sorted(((dot(v, w), j) for m, j, other, w in usable if m != n and other == lab), key=key)[:positives]
        others = sorted(((dot(v, w), j) for _, j, other, w in usable if other != lab), key=key)
        for p, j in same:
            window = [(s, k) for s, k in others if low * p <= 100 * s <= high * p][:negatives]
            for rank, (s, k) in enumerate(window, 1):
                out[(i, j, rank, k, p, s)] += 1
    return out


def odd_vectors():
    rnd = random.Random(4)
    vector = lambda: [rnd.gauss(0, 0.4) for _ in range(6)]
    rows = [(i, vector(), rnd.randrange(3)) for i in range(240)]
    rows += [(5, rows[5][1], rows[5][2]), (5, vector(), 1), (10, rows[10][1], rows[10][2])]  # repeated ids and rows
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(300, 330)]  # ties
    rows += [(340, None, 1), (345, [0.1, None], 1), (350, [math.nan, 1.0], 0), (355, [math.inf], 0), (360, vector(), None)]
    rows += [(365, [], 1), (370, [0.3, 0.2], 2), (None, vector(), 1), (None, vector(), 0), (375, [0.0] * 6, 0)]
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 24, 20 * 6 * 8])
def test_hard_negatives(spark, block_bytes):
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, lab, "x", 0.5, 1) for i, v, lab in rows], VECTORS).repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), block_bytes=block_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined_by_force(rows, lambda i: i is not None and i % 5 == 0)
    assert len(want) > 100 and Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("size", [4.0, 2.0**14, 2.0**21])
def test_hard_negatives_of_any_size_are_exact(spark, size):
    """float32, float64 and Python integers."""
    rnd = random.Random(7)
    rows = [(i, [rnd.uniform(-size, size) for _ in range(4)], i % 2) for i in range(60)]
    df = spark.createDataFrame([(i, v, lab, None, None, None) for i, v, lab in rows], VECTORS)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"))
    assert Counter(map(tuple, got.collect())) == mined_by_force(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0


def test_threshold_search_stops_early_and_misses_nothing():
    rng = np.random.default_rng(0)
    values = np.floor(rng.normal(0, 40, (4000, 4))).astype(np.float64)
    lists = hard_negatives.SortedLists(values)
    read = []
    for q in values[:40]:
        rows, scores = lists.search(q, np.zeros(4000, bool), lambda t, s: (k := hard_negatives._kth(s, 5)) is not None and t < k)
        read.append(len(rows))
        assert sorted(scores, reverse=True)[:5] == sorted(values @ q, reverse=True)[:5]
    assert np.median(read) < 2500


# -- collocations ----------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, h1 long, score long, phrase string"


def collocations_by_force(rows, top, least, cover):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang, text = lang if lang is not None else "und", text or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for c in ".,;:!?\x0a\x0b\x0c\x0d":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            words = piece.replace("\t", " ").split(" ")
            words = [w for w in words if w]
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[(lang, *words[i : i + k])] += 1
    found, longer = [], Counter()
    for (lang, *p), a in f.items():
        if len(p) > 1 and a >= least:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[(lang, *p[i : i + k])] = max(longer[(lang, *p[i : i + k])], a)
    for (lang, *p), a in f.items():
        if len(p) < 2 or a < least or (longer[(lang, *p)] and 100 * longer[(lang, *p)] >= cover * a):
            continue
        score, _, l, r = min((2_000_000 * a // (f[(lang, *p[:k])] + f[(lang, *p[k:])]), k, f[(lang, *p[:k])], f[(lang, *p[k:])]) for k in range(1, len(p)))  # noqa: E741
        found.append((lang, -score, -a, " ".join(p).encode(), l, r))
    out = set()
    for lang in total:
        for rank, (_, s, a, p, l, r) in enumerate(sorted(x for x in found if x[0] == lang)[:top], 1):  # noqa: E741
            out.add((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return out


def odd_texts():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["É", "Über", "x-y", "1"]
    rows = []
    for i in range(300):
        lang = ("en", "de", None, "und")[i % 4]
        text = " ".join(rnd.choices(words, weights=range(34, 0, -1), k=rnd.randrange(0, 60)))
        if i % 3 == 0:
            text += rnd.choice([". New York City hall,", " new york; ", "\tnew\t york  city\n", "! Alpha beta gamma delta: alpha beta gamma delta"])
        rows.append((text, lang))
    rows += [(None, "en"), ("", None), (" \t.,;\n", "de"), ("é" * 5000, "en"), ("same words here " * 400, "fr"), ("same words here " * 400, "fr")]
    return rows


@pytest.mark.parametrize("top, least, batch, growth", [(2000, 3, 8, 8), (7, 2, 1, 2), (12, 5, 2, 3)])
def test_collocations(spark, top, least, batch, growth):
    rows = odd_texts()
    docs = spark.createDataFrame([(i, t, lang, 1, 2, "x") for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    got = collocations.collocations(docs, top=top, least=least, batch=batch, growth=growth)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == collocations_by_force(rows, top, least, 80)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, 1, 1, "x")], DOCS)).count() == 0


def test_windows_of_a_long_text_count_every_phrase_once(monkeypatch):
    rnd = random.Random(5)
    text = "".join(rnd.choice(["ab", "c", "Long-word" * 3, " ", " ", "\t", ". ", "x y "]) for _ in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], names=["text", "lang"])

    class Everything:
        value = np.full(1 << (collocations.FILTER_BITS - 6), 0xFFFFFFFFFFFFFFFF, np.uint64)

    every = Everything()
    counters = [collocations._count_words(0), collocations._count_pairs(0, every), collocations._count_triples(0, *[every] * 4), collocations._count_quads(0, *[every] * 5)]

    def counted(run, k):
        out = Counter()
        for b in run(iter([batch])):
            for row in zip(*[b.column(f"h{i + 1}").to_pylist() for i in range(k)], b.column("a").to_pylist()):
                out[row[:-1]] += row[-1]
        return +out

    whole = [counted(run, k) for k, run in enumerate(counters, 1)]
    monkeypatch.setattr(collocations, "CHUNK", 50)
    assert [counted(run, k) for k, run in enumerate(counters, 1)] == whole
    assert len(whole[3]) > 20


def test_scores_are_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(2**61, 2**61 + 3, 2**62 - 1)], "a long, l long, r long")
    got = big.select(collocations.ratio("a", "l", "r").alias("s")).first().s
    assert got == 2_000_000 * 2**61 // (2**61 + 3 + 2**62 - 1)


# -- pages -----------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, wrapper string, text string"


class Reference(HTMLParser):
    """Blocks of well-formed pages: all text in <article> but in left-out tags."""

    LEFT_OUT = {"nav", "aside", "footer", "form", "script", "style"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out, self.blocks, self.piece = 0, [], [], []

    def flush(self):
        text = " ".join("".join(self.piece).split())
        if text:
            self.blocks.append(text)
        self.piece = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("b", "i", "a", "em"):
            self.flush() if tag != "br" else self.piece.append(" ")
        self.inside += tag == "article"
        if tag in self.LEFT_OUT or ("class", "comments") in attrs or ("class", "ad") in attrs:
            self.out.append(tag)

    def handle_endtag(self, tag):
        if tag not in ("b", "i", "a", "em"):
            self.flush()
        self.inside -= tag == "article"
        if self.out and self.out[-1] == tag:
            self.out.pop()

    def handle_data(self, data):
        if self.inside and not self.out:
            self.piece.append(data)


def article_pages():
    rnd = random.Random(9)
    words = lambda n: " ".join(rnd.choice(["alpha", "beta &amp; co", "g&#233;", "1 &lt; 2", "delta"]) for _ in range(n))
    rows = []
    for i in range(60):
        inner = f"<h1>{words(3)}</h1>"
        for _ in range(rnd.randrange(1, 6)):
            inner += rnd.choice([f"<p>{words(5)} <b>{words(2)}</b><br>{words(2)}</p>", f"<ul><li>{words(2)}</li><li>{words(1)}</li></ul>", f"<h2>{words(2)}</h2><p>{words(9)}</p>", f'<div class="ad">{words(3)}</div>', f"<aside>{words(4)}</aside>", f"<blockquote><p>{words(6)}</p></blockquote>", f"<table><tr><td>{words(1)}</td><td>{words(2)}</td></tr></table>"])
        page = f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href='/'>{words(1)}</a></nav><article>{inner}</article>"
        page += rnd.choice(["", f'<div class="comments"><p>{words(20)}</p></div>']) + f"<footer>&copy; {words(2)}</footer></body></html>"
        rows.append((i, f"https://H{i % 4}.example.com/{i}", page))
    return rows


def by_page(df):
    out: dict = {}
    for r in df.collect():
        assert r.n_chars == len(r.text)
        out.setdefault(r.page_id, []).append(r.text)
    return out


def test_pages_equal_a_reference_parser(spark):
    rows = article_pages()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(5)
    got = html_extract.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = by_page(got)
    for i, _, page in rows:
        ref = Reference()
        ref.feed(page)
        ref.flush()
        assert found[i] == ["\n".join(ref.blocks)], page


def test_article_is_found_without_its_element(spark):
    """The wrapper of the host tells the varying text from the template."""
    rnd = random.Random(2)
    words = lambda n: " ".join(rnd.choice("kappa lambda mu nu xi omicron pi rho".split()) for _ in range(n))
    rows, want = [], {}
    for i in range(12):
        paragraphs = [words(30 + i) for _ in range(2 + i % 3)]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        promo = "<div class='x'><p>Read our terms and conditions before you go on reading this page, please.</p></div>" if i % 2 else ""
        rows.append((i, "http://a.example/" + str(i), f"<body><div id='top'><div class='links'><a href='/a'>{words(2)}</a> <a href='/b'>{words(2)}</a></div></div>{promo}<div class='story'>{body}<p>All rights reserved.</p></div><div class='legal'>Imprint, privacy and contact data</div></body>"))
        want[i] = ["\n".join(paragraphs)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES).repartition(4)
    got = by_page(html_extract.main_text(df))
    # the constant last paragraph is folded into the repeated one, so it stays
    assert {i: [t[0].removesuffix("\nAll rights reserved.")] for i, t in got.items()} == want


def test_odd_pages(spark):
    rows = [
        (1, "http://a.example/1", None), (2, None, ""), (3, "not a url", "  \n "), (4, "http://b.example", "plain &amp; simple\n text"),
        (None, None, "<article><p>one<p>two <b>bold<br><p>three</article>"), (5, "http://c.example", "<article>x < y <!-- c --> z &am &amp</article"),
        (6, "http://c.example", "<p class=\"a>b\">q</p><script>var a='</p>';</script><article id=1>main<!-- open"),
        (7, "http://d.example", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"),
        (7, "http://d.example", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"),
        (8, "http://e.example", "<article>" + "".join(f"<p>{i}</p><h2>{i}</h2><ul><li>{i}</ul>" for i in range(400)) + "</article>"),
        (9, "http://e.example", "<article>" + "".join(f"<div class=c{chr(97 + i % 26)}{chr(97 + i // 26)}>{i}</div>" for i in range(300)) + "</article>"),
        (10, "http://e.example", "<article><header><p>by me</p><h1>Title</h1></header><p>é" + "word " * 30000 + "</p></article>"),
    ]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES).repartition(3)
    got = by_page(html_extract.main_text(df))
    assert got[1] == got[2] == got[3] == [""] and got[4] == ["plain & simple text"]
    assert got[None] == ["one\ntwo bold\nthree"]
    assert got[5] == ["x < y z &am &"] and got[6] == ["main"] and got[7] == ["deep", "deep"]
    assert got[8] == ["\n".join(f"{i}\n{i}\n{i}" for i in range(400))]
    assert got[9] == ["\n".join(map(str, range(300)))]
    assert got[10] == ["Title\né" + " ".join(["word"] * 30000)]


def test_no_pages(spark):
    assert html_extract.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_many_hosts_meet_their_wrappers_by_a_salted_join(spark, monkeypatch):
    rows = article_pages()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(5)
    plain = by_page(html_extract.main_text(df))
    monkeypatch.setattr(html_extract, "BROADCAST_CHARS", 0)
    monkeypatch.setattr(html_extract, "FAN_IN", 2)
    assert by_page(html_extract.main_text(df)) == plain


def test_expression_of_repeats_and_options():
    """<h2><p>+ in turn becomes one repeated group; what one page lacks is optional."""
    first = html_extract.expression(html_extract.parse("<div><h2>a</h2><p>b</p><p>c</p><h2>d</h2><p>e</p></div>"))
    other = html_extract.expression(html_extract.parse("<div><h2>a</h2><p>x</p><blockquote>q</blockquote></div>"))
    shape = lambda x: (x["s"], x["o"], x["r"])
    assert [shape(x) for x in first["k"][0]["k"]] == [("(h2 p)", 0, 1)]
    both = html_extract.merge(first, other)["k"][0]
    assert [shape(x) for x in both["k"]] == [("(h2 p)", 0, 1), ("blockquote", 1, 0)]
    h2, p = both["k"][0]["k"]
    assert h2["k"][0]["t"] is None and p["r"] == 1
