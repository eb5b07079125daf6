"""PII: bootstrapped contextual extraction, in DataFrame operations only.

Seeds are the entities that four patterns find (e-mail, ip, card, phone), the
base, and secrets: quoted values of 16 characters or more, a digit among them,
behind a lower-case label like ``token =``.  Secrets are extra spans, as are
those that the patterns find.  The words around a seed, or the label written into its token, make lexical
patterns.  Patterns and the identifier-like tokens of the whole corpus form a
graph, which is scored in turns: a pattern's score for a kind is the share of
the kind's instances among all that it meets (one more counts as foreign), an
instance's score the chance that one of its trusted patterns is right.
Patterns that end above ``accept`` with enough instances find the identifiers
which no seed pattern knows; these spans are added, base spans stay.

Positions are code points, ends exclusive.  They follow from splitting a text
at its matches: lengths of gaps and matches, summed in order.

Defined results.  A null text counts as empty.  Empty texts have no spans.
Rows that repeat an id with its text get the same spans.  A null doc_id is
carried as null.  Other columns are not read.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.shared import fresh, sent_if_few, staged

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that a match needs no backtracking over what
#: it has read (a run is entered at its start or where the last match ended).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<=\b(?:token|secret|password|api_key)\x20{0,2}[=:]\x20{0,2}[\"'])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+(?=[\"'])",
}
#: The kinds whose seeds are base spans, and all kinds.
SEEDS = (*KINDS, "secret")
#: Texts without these cannot hold a valid match of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}[0-9]", "phone": r"\+[0-9]", "secret": r"(?:token|secret|password|api_key)\x20{0,2}[=:]"}
#: Tokens that may be identifiers: a digit or an at sign between blanks.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Tokens of digits that stand close together are one candidate: the gap, a
#: token that may be followed by another, one that may follow.
NEAR = r"^[\x20\t()\[\]-]{1,5}$"
GOES_ON, FOLLOWS = r"^[^0-9@]*+[0-9][0-9()\[\]./-]*(?<=[0-9)\]-])$", r"^[(\[-]*+[0-9][0-9()\[\]./-]*+[\"')\]}>.,;:!?]*$"
#: The context: at most two whole words before a token, one after it.
LAST_WORDS, FIRST_WORD = r"(?<!\S)(\S++(?:\s++\S++)?+)\s*+$", r"^\s*+(\S++)"
TRIM_LEFT, TRIM_RIGHT = "^[\"'(\\[{<]+", "[\"')\\]}>.,;:!?]+$"


def _matches(text: Column, pattern: str, wanted: Column, fields) -> Column:
    """Array of ``fields(gap, match, number, next gap)`` of the matches of a
    pattern; the next gap of the last match is the rest of the text."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(found.alias("m"), gaps.alias("g"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("n"))
    made = F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()), lambda x, i: fields(x["g"], x["m"], i, x["n"]))
    return F.when(wanted, made)


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    byte = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    size = F.char_length(digits)
    return (
        (kind == "email")
        | ((kind == "ip") & match.rlike(rf"^{byte}(?:\.{byte}){{3}}$"))
        | ((kind == "card") & size.between(14, 19) & F.expr("luhn_check(regexp_replace(match, '[^0-9]', ''))"))
        | ((kind == "phone") & size.between(10, 15))
        | (kind == "secret")
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(0).cast("long")).alias("id"), F.xxhash64(doc.isNull(), text).alias("row"), text.alias("text"))


def _scan(texts: DataFrame) -> DataFrame:
    """One pass over the texts: the matches of each pattern as gap length and
    match, the tokens with the words before and after them."""
    t = F.col("text")
    base = [
        _matches(t, PATTERNS[k], t.rlike(HINTS[k]), lambda g, m, i, _, n=n, k=k: F.struct(F.lit(n).alias("rank"), F.lit(k).alias("kind"), i.alias("i"), F.char_length(g).alias("gap"), m.alias("match")))
        for n, k in enumerate(SEEDS)
    ]
    tokens = _matches(
        t, TOKEN, t.rlike("[0-9@]"),
        lambda g, m, i, n: F.struct(i.alias("i"), F.char_length(g).alias("gap"), m.alias("match"), g.rlike(NEAR).alias("near"), F.regexp_extract(g, LAST_WORDS, 1).alias("before"), F.regexp_extract(n, FIRST_WORD, 1).alias("after")),
    )
    scanned = texts.select("id", "row", F.flatten(F.filter(F.array(*base), lambda a: a.isNotNull())).alias("base"), tokens.alias("tokens"))
    return staged(scanned.where((F.size("base") > 0) | (F.size("tokens") > 0)).dropDuplicates(["id", "row"]), "pii-scan")


def _placed(rows: DataFrame, *by: str) -> DataFrame:
    """Start and end of each match: gaps and matches before it, in order."""
    w = Window.partitionBy("id", "row", *by).orderBy("i")
    size = F.char_length("match")
    return rows.withColumn("end", F.sum(F.col("gap").cast("long") + size).over(w)).withColumn("start", F.col("end") - size)


def base_spans(scanned: DataFrame) -> DataFrame:
    """id, row, rank, kind, start, end, match of the valid matches of the seeds."""
    rows = scanned.select("id", "row", F.explode("base").alias("b")).select("id", "row", "b.*")
    return _placed(rows, "rank").where(_valid(F.col("kind"), F.col("match"))).select("id", "row", "rank", "kind", "start", "end", "match")


def _occurrences(scanned: DataFrame, spans: DataFrame) -> DataFrame:
    """Identifier-like tokens with their patterns; ``kind`` where a base span
    starts in the token; tokens that only continue one belong to that token.
    Tokens of digits outside base spans that only a short gap separates are one.
    The words after are those after the last token."""
    rows = scanned.select("id", "row", F.explode("tokens").alias("t")).select("id", "row", "t.*")
    by_doc = Window.partitionBy("id", "row").orderBy("i")
    rows = _placed(rows)
    lead = F.char_length(F.regexp_extract("match", TRIM_LEFT, 0))
    core = F.regexp_replace(F.regexp_replace("match", TRIM_LEFT, ""), TRIM_RIGHT, "")
    # the bracket of an area code belongs to a candidate that goes on after it
    wide = F.when(F.col("match").rlike(r"^[\"'(\[{<]*\([0-9]+\)$"), 1).otherwise(0)
    rows = rows.select(
        "id", "row", "i", (F.col("start") + lead).alias("start"), (F.col("start") + lead - wide).alias("wide"), core.alias("token"), F.lower("before").alias("before"), F.lower("after").alias("after"),
        (F.col("near") & F.col("match").rlike(FOLLOWS)).alias("follows"), F.col("match").rlike(GOES_ON).alias("goes_on"),
    )
    rows = rows.where(F.char_length("token") > 0).withColumn("end", F.col("start") + F.char_length("token"))
    # a running maximum over base spans that start before a token ends
    tokens = rows.select("id", "row", (F.col("end") - 1).alias("at"), F.lit(1).alias("turn"), F.struct("i", "start", "wide", "end", "token", "before", "after", "follows", "goes_on").alias("t"))
    marks = spans.select("id", "row", F.col("start").alias("at"), F.lit(0).alias("turn"), F.struct("end", "start", "kind", "match").alias("span"))
    upto = Window.partitionBy("id", "row").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    met = marks.unionByName(tokens, allowMissingColumns=True).withColumn("last", F.max("span").over(upto)).where("turn = 1").select("id", "row", "t.*", "last")
    met = met.withColumn("covered", F.coalesce(F.col("last.end") > F.col("start"), F.lit(False)))
    begins = F.col("covered") & (F.col("last.start") >= F.col("start"))
    joins = (F.col("covered") & ~begins) | (F.col("follows") & ~F.col("covered") & F.lag("goes_on").over(by_doc) & ~F.lag("covered").over(by_doc))
    met = met.withColumns({"kind": F.when(begins, F.col("last.kind")), "entity": F.when(begins, F.col("last.match")), "joins": F.coalesce(joins, F.lit(False))})
    met = met.withColumn("part", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(by_doc))
    run = F.sort_array(F.collect_list(F.struct("i", "start", "wide", "end", "token", "before", "after", "kind", "entity")))
    met = met.groupBy("id", "row", "part").agg(run.alias("run")).withColumns({"first": F.element_at("run", 1), "ends": F.element_at("run", -1)})
    met = met.select(
        "id", "row", F.when((F.size("run") > 1) & F.col("first.kind").isNull(), F.col("first.wide")).otherwise(F.col("first.start")).alias("start"), "ends.end",
        F.array_join(F.transform("run", lambda x: x["token"]), " ").alias("token"), "first.before", "ends.after", "first.kind", "first.entity",
    ).withColumn("entity", F.coalesce("entity", "token"))
    words = F.split("before", r"\s+")
    two = F.when(F.size(words) == 2, F.array_join(words, " ")).otherwise("")
    one = F.element_at(words, -1)
    right = F.coalesce("after", F.lit(""))
    label = F.regexp_extract(F.lower("token"), r"^([^0-9@]+[=:#])", 1)
    patterns = F.array(
        F.when(two != "", F.concat(F.lit("before "), two)),
        F.when((one != "") & (right != ""), F.concat(F.lit("between "), one, F.lit(" _ "), right)),
        F.when(label != "", F.concat(F.lit("label "), label)),
    )
    like = F.col("kind").isNotNull() | (F.char_length(F.regexp_replace("token", "[^0-9]", "")) >= 4) | F.col("token").contains("@")
    return met.where(like).select("id", "row", "start", "end", F.lower("entity").alias("instance"), "kind", F.filter(patterns, lambda p: p.isNotNull()).alias("patterns"))


def score_patterns(edges: DataFrame, rounds: int = 3, trust: float = 0.5, support: int = 3) -> DataFrame:
    """pattern, kind, score, support.  edges: pattern, instance, kind (of a
    seed, else null), each once."""
    seeds = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("s")).distinct()
    foreign = edges.where("kind is null").select("pattern", "instance")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("all"))
    known, scores = seeds, None
    for turn in range(rounds):
        scores = (
            edges.select("pattern", "instance").distinct().join(known, "instance").groupBy("pattern", "kind").agg(F.sum("s").alias("sum"), F.count("*").alias("support"))
            .join(sizes, "pattern").select("pattern", "kind", (F.col("sum") / (F.col("all") + 1)).alias("score"), "support")
        )
        scores = staged(scores, "pii-patterns")
        if turn < rounds - 1:
            trusted = scores.where((F.col("score") >= trust) & (F.col("support") >= support))
            new = foreign.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("s"))
            known = staged(seeds.unionByName(new.join(seeds.select("instance", "kind"), ["instance", "kind"], "left_anti")), "pii-instances")
    return scores


def find_spans(texts: DataFrame, accept: float = 0.6, support: int = 3, rounds: int = 3) -> DataFrame:
    """id, row, rank, kind, start, end, base: base spans, secrets and those that
    the accepted patterns add.  ``texts`` as ``keyed`` gives them."""
    scanned = _scan(texts)
    base = staged(base_spans(scanned), "pii-base")
    tokens = staged(_occurrences(scanned, base), "pii-tokens")
    meets = tokens.select("id", "row", "start", "end", "instance", "kind", F.explode("patterns").alias("pattern"))
    edges = staged(meets.select("pattern", "instance", "kind").distinct(), "pii-edges")
    scores = score_patterns(edges, rounds, support=support)
    accepted = scores.where((F.col("score") >= accept) & (F.col("support") >= support)).groupBy("pattern").agg(F.max(F.struct("score", "kind")).alias("best"))
    rank = F.array_position(F.array(*map(F.lit, SEEDS)), F.col("best.kind")).cast("int") - 1
    found = (
        meets.where("kind is null").join(accepted, "pattern").groupBy("id", "row", "start", "end").agg(F.max("best").alias("best"))
        .select("id", "row", rank.alias("rank"), F.col("best.kind").alias("kind"), "start", "end", F.lit(False).alias("base"))
    )
    return base.drop("match").withColumn("base", F.col("kind").isin(*KINDS)).unionByName(found)


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id and ``spans``: array of (start, rank, kind, end, base), sorted."""
    texts = keyed(docs, id_col, text_col)
    spans = find_spans(texts, **options).groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end", "base"))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return texts.select("doc_id", "id", "row").join(spans, ["id", "row"], "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each span replaced by its kind, like [EMAIL]; spans that
    overlap become one, named after the first.  Null texts stay null."""
    spans = find_spans(keyed(docs, id_col, text_col), **options)
    name, key, cuts = (fresh(docs, c) for c in ("pii_id", "pii_row", "pii_spans"))
    order = Window.partitionBy("id", "row").orderBy("start", "rank", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = spans.withColumn("new", (before.isNull() | (before <= F.col("start"))).cast("int"))
    grouped = flagged.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = grouped.groupBy("id", "row", "part").agg(F.min(F.struct("start", "rank", "kind")).alias("first"), F.max("end").alias("end"))
    merged = merged.groupBy(F.col("id").alias(name), F.col("row").alias(key)).agg(F.sort_array(F.collect_list(F.struct("first.start", "first.kind", "end"))).alias(cuts))
    merged = sent_if_few(staged(merged, "pii-merged"))
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    marked = docs.withColumns({name: F.coalesce(doc, F.lit(0).cast("long")), key: F.xxhash64(doc.isNull(), text)})
    met = marked.join(merged, [name, key], "left")
    s, t = F.col(cuts), F.col(text_col)
    # the text before each span (after the span before it), and its kind
    pieces = F.transform(
        s,
        lambda x, i: F.concat(
            F.substring(t, F.when(i > 0, F.get(s, i - 1)["end"]).otherwise(0).cast("int") + 1, (x["start"] - F.when(i > 0, F.get(s, i - 1)["end"]).otherwise(0)).cast("int")),
            F.lit("["), F.upper(x["kind"]), F.lit("]"),
        ),
    )
    rest = F.substring(t, F.element_at(s, -1)["end"].cast("int") + 1, F.lit(2147483647))
    out = F.when(s.isNull(), t).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return met.withColumn(text_col, out).select(*docs.columns)
