"""Exact dedup: tree-merge of sorted digest runs.

Each partition of the input turns into a run: one entry per distinct digest,
sorted.  Runs are then exchanged in binomial rounds.  In round ``r`` the
2**bits runs whose numbers differ only in digit ``r`` meet; each of them keeps
one share of the digest range (digit ``r`` of the digest) and merges what the
others send.  After the last round every run owns its share of the digests and
holds one entry for each of them.  At every level a merge retains, per
verified digest, the entry with the most code points, then the smallest
identifier, and adds up the counts, so a group of copies shrinks before it
moves on: a hot group sends one entry per run and round, never its rows.

Defined results.  A null text counts as empty; empty texts are equal to each
other.  A null doc_id loses against any other.  Rows that repeat both doc_id
and text are copies like others: exactly one of them is kept.  Other columns
are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.shared import fresh, sent_if_few, staged

#: The white space that normalisation deletes: code points 32 and 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
ROUND_BITS = 3


def normalised(text):
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row number, id, code points, digest, check.

    ``check`` (length and a second hash of the normalised text) must agree as
    well before two entries of one digest merge."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    flat = docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).cast("long").alias("points"), normalised(text).alias("flat"))
    return flat.select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        "doc_id",
        "points",
        F.unhex(F.sha2(F.col("flat").cast("binary"), 256)).alias("digest"),
        F.struct(F.octet_length("flat").alias("bytes"), F.xxhash64("flat").alias("hash")).alias("check"),
    )


def _better():
    """Order of the entries of one digest: most code points, smallest id."""
    return F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("row"))


def merge_runs(entries: DataFrame, runs: int, bits: int = ROUND_BITS) -> DataFrame:
    """Merge the runs of ``entries`` (run, digest, check, best, group_size) in
    binomial rounds; ``runs`` is a power of 2**bits.  Every round is a sorted
    aggregate by (meeting run, digest): each task merges its own sorted run
    first, then the shuffled runs are merged."""
    digit_of = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    radix, rounds = 1 << bits, 0
    while radix**rounds < runs:
        rounds += 1
    for r in range(rounds):
        place = radix**r
        own = F.expr(f"(run div {place}) % {radix}")
        digit = F.shiftright(digit_of, bits * r) % radix
        entries = (
            entries.withColumn("run", F.col("run") - own * place + digit * place)
            .groupBy("run", "digest", "check")
            .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
        )
    return entries


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = ROUND_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row per input row."""
    rows = staged(digests(docs, id_col, text_col), "digests")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.agg(F.max("run")).first()[0] or 0) + 1)
    runs = 1 << bits
    while runs < tasks and runs < 4096:
        runs <<= bits
    entries = rows.select((F.col("run") % runs).cast("long").alias("run"), "digest", "check", _better().alias("best"), F.lit(1).cast("long").alias("group_size"))
    best = merge_runs(entries, runs, bits).select("digest", "check", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    # Only groups of two rows or more need their entry; a hot digest is a
    # skewed join key, whose rows adaptive execution deals to several tasks.
    several = best.where("group_size > 1")
    return rows.join(several, ["digest", "check"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("keep_row").isNull() | (F.col("keep_row") == F.col("row"))).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose against an equal text, columns as
    given.  The rows to drop are few and found by (doc_id, digest)."""
    groups = staged(exact_groups(docs, id_col, text_col), "exact-groups")
    name, digest, n = (fresh(docs, c) for c in ("dedup_id", "dedup_digest", "dedup_n"))
    by = [name, digest]
    lost = (
        groups.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(name), F.col("digest").alias(digest))
        .agg(F.sum(F.col("kept").cast("int")).alias("stay"), F.count("*").alias("rows"))
        .where("stay < rows")
    )
    lost = staged(lost, "exact-lost")
    gone, twice = (sent_if_few(lost.where(c).select(*by)) for c in ("stay = 0", "stay > 0"))
    marked = docs.withColumns({name: F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest: F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))})
    kept = marked.join(gone, by, "left_anti")
    if twice.limit(1).count():  # rows that repeat an id with its text: one of each stays, the one of most code points
        # an aggregate, so a hot group sends one row per task and never its texts
        text = F.coalesce(F.col(text_col), F.lit(""))
        best = F.max_by(F.struct(*docs.columns), F.struct(F.char_length(text), text))
        once = kept.join(twice, by, "left_semi").groupBy(*by).agg(best.alias(n)).select(f"{n}.*")
        kept = kept.join(twice, by, "left_anti").select(*docs.columns).unionByName(once)
    return kept.select(*docs.columns)
