"""ST6 in the batch predictor: laps taken as they arrive.

``top_so_far`` gives every row the ``n`` highest entries of all rows of its key
that have arrived up to it -- no window frame can say that, since a late entry
may be lower than entries that arrived before it.  It is a chain of ``n``
running maxima: the first keeps the highest entry so far; what an arriving
entry displaces there (the lower of it and the old maximum) goes on to the
second, and so on.  Each link is two window functions over the same
partitioning and order, so the whole chain shares one shuffle and one sort.

The scan is associative: the ``n`` highest of two stretches are the ``n``
highest of both results.  A key with more than ``block_rows`` rows is cut into
blocks; each block's ``n`` highest are its summary, a scan over the summaries
(``n`` rows for each block) gives what every block starts with, and those
entries come first in the block's own chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.plans.lineage import materialize
from pitwall.plans.sequence import BLK, DEFAULT_BLOCK_ROWS, HALO, SKEW_KEY_ROWS, carry_forward, number_rows_sized, with_blocks
from pitwall.schemas import TS

ENTRY = "_entry"


def _chain(df: DataFrame, keys: Sequence[str], order: Sequence[Column], entry: str, n: int, out: str) -> DataFrame:
    """``out``: array of the n highest entries up to each row, highest first."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    upto, before = (ordered.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    df = df.withColumn("_in0", F.col(entry))
    for j in range(n):
        arriving, held = F.col(f"_in{j}"), F.col(f"_held{j}")
        df = df.withColumns({f"_top{j}": F.max(arriving).over(upto), f"_held{j}": F.max(arriving).over(before)})
        displaced = F.when(held.isNotNull() & arriving.isNotNull(), F.least(held, arriving))
        df = df.withColumn(f"_in{j + 1}", displaced).drop(f"_in{j}", f"_held{j}")
    tops = [f"_top{j}" for j in range(n)]
    return df.withColumn(out, F.filter(F.array(*tops), lambda e: e.isNotNull())).drop(*tops, f"_in{n}")


def top_so_far(df: DataFrame, keys: Sequence[str], rn: str, entry: Column, n: int, out: str,
               block_rows: int = DEFAULT_BLOCK_ROWS, longest: int | None = None, total_rows: int | None = None) -> DataFrame:
    """``out`` = the n highest ``entry`` values (structs, compared field by
    field) of the key's rows with a row number of at most this one's.  The
    result carries ``_blk``; null entries are passed over."""
    keys = list(keys)
    blocked = with_blocks(df, keys, rn, block_rows, longest=longest, total_rows=total_rows).withColumn(ENTRY, entry)
    arrival = [F.col(rn).asc_nulls_first()]
    if longest is not None and longest <= block_rows:
        return _chain(blocked, [*keys, BLK], arrival, ENTRY, n, out).drop(ENTRY, HALO)
    blocked = materialize(blocked)
    best = Window.partitionBy(*keys, BLK).orderBy(F.col(ENTRY).desc())
    summary = (
        blocked.where(F.col(ENTRY).isNotNull())
        .select(*keys, BLK, ENTRY, F.row_number().over(best).alias("_nth"))
        .where(F.col("_nth") <= n)
    )
    reached = _chain(summary, keys, [F.col(BLK), F.col("_nth").desc()], ENTRY, n, "_reached")
    # A block's first-ranked row closes its summary: what stands there is held.
    starts = reached.where(F.col("_nth") == 1).select(
        *keys, (F.col(BLK) + 1).alias(BLK), F.lit(True).alias(HALO), F.explode("_reached").alias(ENTRY)
    )
    # A block without entries hands on what it was given: fill by the last block.
    starts = _carried_starts(starts, blocked, keys)
    whole = blocked.unionByName(starts, allowMissingColumns=True)
    return _chain(whole, [*keys, BLK], arrival, ENTRY, n, out).where(~F.col(HALO)).drop(ENTRY, HALO)


def _carried_starts(starts: DataFrame, blocked: DataFrame, keys: list[str]) -> DataFrame:
    """Starting entries of every block that exists: those given by the last
    earlier block that had entries."""
    blocks = blocked.select(*keys, BLK).distinct()
    given = starts.select(*keys, BLK).distinct().withColumn("_from", F.col(BLK))
    earlier = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, 0)
    held = (
        blocks.join(given, [*keys, BLK], "left")
        .withColumn("_from", F.last("_from", ignorenulls=True).over(earlier))
        .where(F.col("_from").isNotNull())
    )
    return starts.withColumnRenamed(BLK, "_from").join(held, [*keys, "_from"]).select(*keys, BLK, HALO, ENTRY)


def _moments(entries: Column) -> dict[str, Column]:
    """Population statistics of the (lap, seconds) entries of one buffer."""
    x, y = (lambda e: e["lap"].cast("double")), (lambda e: e["seconds"])
    k = F.size(entries)
    total = lambda f: F.aggregate(entries, F.lit(0.0), lambda a, e: a + f(e))
    return {"k": k, "mx": total(x) / k, "my": total(y) / k}


def rolling_predict_arrival(
    laps: DataFrame, *, key: str | list[str] = "PilotNumber", lap: str = "Lap", y: str = "Seconds", ts: str = TS,
    n: int = 10, cadence: int = 2, reg: float = 0.01, tiebreak: tuple[str, ...] = (),
    block_rows: int = DEFAULT_BLOCK_ROWS, max_key_rows: int | None = SKEW_KEY_ROWS,
) -> DataFrame:
    """W1 + ST6: one prediction per lap row, rows taken in the order of ``ts``
    (then Lap and ``tiebreak``; rows without a time first).  A driver's buffer
    holds the n highest laps that have arrived; of repeated laps the later one
    stands higher.  ``NextLap`` follows the highest lap seen, so a late lap may
    enter the buffer but never lowers it.  Same columns as ``rolling_predict``."""
    from pitwall.operators.regress import EARLY_REFIT_BELOW, _keys, ridge_terms

    keys = _keys(key)
    base = laps.where(F.col(lap).isNotNull() & F.col(y).isNotNull())
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    numbered, longest = number_rows_sized(base, keys, [F.col(ts).asc_nulls_first(), F.col(lap), *tiebreak], "_rn", max_key_rows=max_key_rows)
    total = numbered.count() if longest > block_rows else None
    when = F.unix_micros(F.col(ts).cast("timestamp"))
    entry = F.struct(F.col(lap).alias("lap"), when.alias("at"), F.col("_rn").alias("rn"), F.col(y).cast("double").alias("seconds"))
    seen = top_so_far(numbered, keys, "_rn", entry, n, "_top", block_rows, longest, total)
    m = _moments(F.col("_top"))
    seen = seen.withColumns({f"_{name}": c for name, c in m.items()})
    centred = lambda f: F.aggregate("_top", F.lit(0.0), lambda a, e: a + f(e["lap"].cast("double") - F.col("_mx"), e["seconds"] - F.col("_my"))) / F.col("_k")
    seen = seen.withColumns({"_vx": centred(lambda u, v: u * u), "_cxy": centred(lambda u, v: u * v), "_sy": F.sqrt(centred(lambda u, v: v * v))})
    slope, icpt = ridge_terms(F.col("_cxy"), F.col("_vx"), F.col("_sy"), F.col("_mx"), F.col("_my"), reg)
    nxt = F.col("_top")[0]["lap"] + 1
    refit = (F.pmod(nxt, F.lit(cadence)) == 0) | (nxt < EARLY_REFIT_BELOW) | (F.col("_rn") == 1)
    fitted = seen.withColumn("NextLap", nxt.cast("int")).withColumn("_model", F.when(refit, F.struct(slope.alias("s"), icpt.alias("i"))))
    carried = carry_forward(fitted, keys, "_rn", "_model", "_use", single_block=longest <= block_rows)
    return carried.select(
        *keys[:-1], F.col(keys[-1]).alias("PilotN"), F.col(lap).alias("Lap"), "NextLap",
        (F.col("_use.s") * F.col("NextLap") + F.col("_use.i")).alias("prediction"),
        F.col("_use.s").alias("slope"), F.col("_use.i").alias("intercept"), F.col(ts),
    )
