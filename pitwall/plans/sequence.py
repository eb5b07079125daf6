"""Skew-safe per-key sequencing.

Sequential per-key work (row numbers, lag / lead, sliding N-row frames, carrying
the last value forward) is usually written as ``Window.partitionBy(key)``.
That sends every row of a key to a single task: with ~20 drivers the whole job
runs 20-way parallel, and a key that holds a third of all rows becomes a third
of the job inside one task.  The helpers here give the same results with
bounded tasks:

``number_rows``
    A first, partial-aggregated job measures the largest key and the total.
    When every key fits one task (``max_key_rows``) a plain ``row_number()``
    window is used.  Otherwise: range-partition on (key, order) into enough
    partitions for ~2M rows each: Spark samples the data to choose the
    bounds, so a hot key is cut into several contiguous chunks on different
    tasks.  Rows are sorted inside each partition and tagged with
    (partition id, monotonically increasing id); this layout is cut from its
    lineage once with a reliable checkpoint so the tags never change on
    recomputation.  A tiny chunk table (one row per key per partition) gives
    each chunk's offset; the row number is offset + position in the chunk.

``with_blocks`` / ``block_window``
    Given a dense per-key row number, rows are grouped into blocks of
    ``block_rows`` rows of one key.  Windows run over (key, block), so no task
    holds more than one block per key.  ``back`` / ``fwd`` halo rows are copied
    from the neighbouring blocks so lag, lead and ``rowsBetween`` frames are
    exact for every non-halo row.

``carry_forward``
    Last non-null value at or before each row: an in-block running ``last``
    plus a per-block summary (about rows / block_rows rows) carried across
    blocks with a window over that small summary.

Keys must be non-null (callers filter unknown drivers first, as the roster
semi-join does).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.plans.joins import bounded_broadcast
from pitwall.plans.lineage import checkpointed, materialize

BLK = "_blk"
HALO = "_halo"
PID = "_pid"
MID = "_mid"

# Rows of one key per window block.  Large enough that the block summary is
# tiny, small enough that a block always fits one task comfortably.
DEFAULT_BLOCK_ROWS = 1 << 20
# Chunk tables up to this many rows are broadcast; beyond it a shuffle join.
CHUNK_BROADCAST_ROWS = 2_000_000
# A key with more rows than this is split across tasks by number_rows.
SKEW_KEY_ROWS = 1 << 20
# Rows per range partition on the split path (a few hundred MB of narrow rows).
RANGE_PARTITION_ROWS = 2_000_000


def key_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the biggest key, all rows) in one job, counted per task first."""
    r = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return int(r[0] or 0), int(r[1] or 0)


def largest_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the biggest key (one job, aggregated per task first)."""
    return key_sizes(df, keys)[0]


def range_partitions(spark, total_rows: int | None) -> int:
    """Range partitions for the split path: the session's shuffle partitions,
    or more so that no partition holds more than ``RANGE_PARTITION_ROWS``."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not total_rows:
        return base
    return max(base, -(-total_rows // RANGE_PARTITION_ROWS))


def longest_sequence(df: DataFrame, rn: str) -> int:
    """Largest dense row number, i.e. rows of the biggest key."""
    return int(df.agg(F.max(rn)).first()[0] or 0)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str = "rn",
    partitions: int | None = None,
    max_key_rows: int | None = SKEW_KEY_ROWS,
) -> DataFrame:
    """Dense 1-based row number per key in ``order`` (like ``row_number()``),
    computed without putting any key bigger than ``max_key_rows`` into a
    single task (``max_key_rows=None`` always splits).

    ``order`` should make (keys, order) unique, otherwise ties are numbered in
    an arbitrary but stable way.
    """
    return number_rows_sized(df, keys, order, out, partitions, max_key_rows)[0]


def number_rows_sized(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str = "rn",
    partitions: int | None = None,
    max_key_rows: int | None = SKEW_KEY_ROWS,
) -> tuple[DataFrame, int]:
    """:func:`number_rows` plus the row count of the biggest key (the largest
    row number), which block windows use to skip halos when every key fits
    one block."""
    keys = list(keys)
    total = None
    if max_key_rows is not None:
        largest, total = key_sizes(df, keys)
        if largest <= max_key_rows:
            return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))), largest
    spark = df.sparkSession
    n = partitions or range_partitions(spark, total)
    laid = materialize(
        df.repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(MID, F.monotonically_increasing_id())
    )
    ck = [f"_ck{i}" for i in range(len(keys))]
    chunks = laid.groupBy(*keys, PID).agg(
        F.min(MID).alias("_start"), F.count(F.lit(1)).alias("_cnt")
    )
    before = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    # The chunk table is tiny and recomputable from the checkpointed layout, so
    # it is only cached; its size decides between broadcast and shuffle join.
    chunks = chunks.select(
        *[F.col(k).alias(c) for k, c in zip(keys, ck)],
        F.col(PID).alias("_cpid"),
        "_cnt",
        (F.col("_start") - F.coalesce(F.sum("_cnt").over(before), F.lit(0))).alias("_base"),
    ).cache()
    chunks = bounded_broadcast(chunks, CHUNK_BROADCAST_ROWS)
    largest = int(chunks.groupBy(*ck).agg(F.sum("_cnt").alias("_n")).agg(F.max("_n")).first()[0] or 0)
    cond = [laid[k].eqNullSafe(chunks[c]) for k, c in zip(keys, ck)] + [laid[PID] == chunks["_cpid"]]
    numbered = (
        laid.join(chunks, cond, "inner")
        .withColumn(out, F.col(MID) - F.col("_base") + 1)
        .drop(*ck, "_cpid", "_base", "_cnt", PID, MID)
    )
    return numbered, largest


def with_blocks(
    df: DataFrame,
    keys: Sequence[str],
    rn: str,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    back: int = 0,
    fwd: int = 0,
    longest: int | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """Add ``_blk`` and ``_halo``; a row within ``back`` rows before a later
    block's first row is also emitted as a halo copy in that block, and a row
    within ``fwd`` rows after an earlier block's last row as a halo copy in
    that one (a frame may span several blocks when blocks are small).

    ``longest`` (rows of the biggest key, if known) skips the copies when
    every key fits one block.  With ``total_rows`` the rows are hash
    partitioned on (keys, block) into ~2M-row partitions -- exactly the
    distribution the block windows need, so no further shuffle follows."""
    if longest is not None and longest <= block_rows:
        return df.withColumn(BLK, F.lit(0).cast("long")).withColumn(HALO, F.lit(False))
    r0 = F.col(rn) - 1
    blk = F.floor(r0 / block_rows)
    copies = [F.struct(blk.alias("b"), F.lit(False).alias("h"))]
    for j in range(1, -(-back // block_rows) + 1 if back else 1):
        copies.append(
            F.when(r0 >= (blk + j) * block_rows - back, F.struct((blk + j).alias("b"), F.lit(True).alias("h")))
        )
    for j in range(1, -(-fwd // block_rows) + 1 if fwd else 1):
        copies.append(
            F.when(
                (blk - j >= 0) & (r0 < (blk - j + 1) * block_rows + fwd),
                F.struct((blk - j).alias("b"), F.lit(True).alias("h")),
            )
        )
    if len(copies) == 1:
        return df.withColumn(BLK, blk).withColumn(HALO, F.lit(False))
    arr = F.filter(F.array(*copies), lambda x: x.isNotNull())
    out = (
        df.withColumn("_cp", F.explode(arr))
        .withColumn(BLK, F.col("_cp.b"))
        .withColumn(HALO, F.col("_cp.h"))
        .drop("_cp")
    )
    if total_rows:
        out = out.repartition(range_partitions(df.sparkSession, total_rows), *keys, BLK)
    return out


def block_window(keys: Sequence[str], rn: str):
    """Window over one block of one key, ordered by the row number."""
    return Window.partitionBy(*keys, BLK).orderBy(rn)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    rn: str,
    value: str,
    out: str,
    single_block: bool = False,
) -> DataFrame:
    """``out`` = last non-null ``value`` at or before each row of its key.

    ``df`` must carry ``_blk`` (see :func:`with_blocks`) and no halo rows.
    ``single_block`` (every key in block 0) skips the cross-block carry.
    """
    keys = list(keys)
    upto = block_window(keys, rn).rowsBetween(Window.unboundedPreceding, 0)
    if single_block:
        return df.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    # The rows are read twice (in-block scan and block summary); write them
    # once so the upstream plan is not run twice.
    inner = checkpointed(df).withColumn(out, F.last(value, ignorenulls=True).over(upto))
    ck = [f"_ck{i}" for i in range(len(keys))]
    summary = inner.groupBy(*keys, BLK).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(rn))).alias("_blast")
    )
    earlier = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *[F.col(k).alias(c) for k, c in zip(keys, ck)],
        F.col(BLK).alias("_cblk"),
        F.last("_blast", ignorenulls=True).over(earlier).alias("_carry"),
    ).where(F.col("_carry").isNotNull())
    cond = [inner[k].eqNullSafe(summary[c]) for k, c in zip(keys, ck)] + [inner[BLK] == summary["_cblk"]]
    return (
        inner.join(summary, cond, "left")
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .drop(*ck, "_cblk", "_carry")
    )


def lag_lead(
    df: DataFrame,
    keys: Sequence[str],
    rn: str,
    cols: dict[str, tuple[str, int]],
    block_rows: int = DEFAULT_BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Add ``out = lag(col, k)`` (k > 0) or ``lead(col, -k)`` (k < 0) per key in
    row-number order, exact across block edges."""
    back = max([k for _, k in cols.values() if k > 0], default=0)
    fwd = max([-k for _, k in cols.values() if k < 0], default=0)
    total = df.count() if longest is not None and longest > block_rows else None
    b = with_blocks(df, keys, rn, block_rows, back=back, fwd=fwd, longest=longest, total_rows=total)
    w = block_window(keys, rn)
    for out, (c, k) in cols.items():
        b = b.withColumn(out, F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w))
    return b.where(~F.col(HALO)).drop(BLK, HALO)
