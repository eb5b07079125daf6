"""Replay pacing: inter-arrival delta (W2) and the bounded-gap send filter.

The replayer sleeps for the delta between consecutive feed messages and sends a
message only when that delta is in (0, 10] seconds; first, simultaneous,
backward and late messages are never sent.  Here the delta is a column and the
send rule a filter.  Message times are rounded half-up to milliseconds first,
like the replayer's 3-decimal rounding.

Two clocks (F4):
  * ``mode="true"``  -- real elapsed seconds (default);
  * ``mode="clock"`` -- the replayer's HHMMSS.fff clock number, where crossing
    a minute adds 40 (so such messages are dropped, as in the reference).

Consecutive messages are found per ``session`` key with the skew-safe
sequencing plan (range partitioning + block windows), so one long session is
still split across many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.scalars import instant_millis, iso_clock_millis
from pitwall.plans.sequence import DEFAULT_BLOCK_ROWS, lag_lead, number_rows_sized

# Fixed values of the replayer.
MAX_DELTA_SECONDS = 10.0


def interarrival(
    messages: DataFrame,
    session: Sequence[str],
    ts: str,
    order: Sequence[str] = (),
    mode: str = "true",
    iso_text: str | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """``delta`` = time of a message minus time of the previous message of
    the same session (null for the first), in seconds or clock units.

    ``ts`` is a TIMESTAMP column; ``iso_text`` (the message's own ISO time)
    is needed for ``mode="clock"``.  ``order`` is the arrival order (e.g. the
    position in the capture file); like the replayer, a message that arrives
    after a later-stamped one gets a negative delta.  Without ``order`` the
    messages are taken in ``ts`` order.
    """
    if mode == "true":
        t = instant_millis(F.col(ts))
    elif mode == "clock":
        if iso_text is None:
            raise ValueError("mode='clock' needs the ISO text column")
        t = iso_clock_millis(F.col(iso_text))
    else:
        raise ValueError("mode is 'true' or 'clock'")
    m = messages.withColumn("_t", t)
    numbered, longest = number_rows_sized(m, list(session), list(order) or [ts], "_seq")
    lagged = lag_lead(numbered, list(session), "_seq", {"_tprev": ("_t", 1)}, block_rows, longest)
    return lagged.withColumn("delta", (F.col("_t") - F.col("_tprev")) / 1000.0).drop("_t", "_tprev", "_seq")


def bounded_gap_filter(with_delta: DataFrame, max_delta: float = MAX_DELTA_SECONDS) -> DataFrame:
    """Keep a message iff 0 < delta <= max_delta."""
    return with_delta.where((F.col("delta") > 0) & (F.col("delta") <= max_delta))


# Fixed value of the replayer: recap and empty messages wait this long.
BYPASS_DELTA = 0.001


def replay_schedule(
    messages: DataFrame,
    session: Sequence[str],
    order: Sequence[str],
    mode: str = "true",
    max_delta: float = MAX_DELTA_SECONDS,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """W2 + P21 over a classified capture (``pitwall.operators.envelope.classify``):
    feed messages are paced against the previous feed message of the session
    (in ``order``) and sent iff 0 < delta <= max_delta; recap and empty
    messages bypass the clock with a fixed 0.001 s and are always sent; lines
    without JSON are never read.  Adds ``delta`` and ``sent``."""
    from pitwall.functions.scalars import iso_to_timestamp

    feed = messages.where(F.col("kind") == "feed").withColumn("_ts", iso_to_timestamp(F.col("msg_time")))
    paced = interarrival(feed, session, "_ts", order=order, mode=mode, iso_text="msg_time", block_rows=block_rows)
    sent = F.coalesce((F.col("delta") > 0) & (F.col("delta") <= max_delta), F.lit(False))
    paced = paced.drop("_ts").withColumn("sent", sent)
    bypass = messages.where(F.col("kind").isin("recap", "empty", "malformed")).select(
        "*", F.lit(BYPASS_DELTA).alias("delta"), F.lit(True).alias("sent")
    )
    return paced.unionByName(bypass)
