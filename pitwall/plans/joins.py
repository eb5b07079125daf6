"""Joins whose broadcast side has a checked or proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The roster is at most this many drivers by construction (first-20 rule).
ROSTER_MAX = 20


def bounded_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``small`` only when it really has at most ``max_rows`` rows.

    The count is an action, so pass a DataFrame that is cached, checkpointed
    or cheap to compute.  Beyond the bound the plain DataFrame is returned and
    Spark plans a shuffle join (AQE may still switch it to a broadcast once
    the real shuffle size is known).
    """
    n = small.count() if small.is_cached else small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


# Rosters are broadcast only up to this many drivers (checked, not assumed).
ROSTER_BROADCAST_ROWS = 100_000


def roster_semi_join(lines: DataFrame, roster: DataFrame, key: str = "PilotNumber", keep=None) -> DataFrame:
    """Keep lines whose driver is in the roster (equi semi-join).

    ``keep`` (a boolean column) also keeps rows that need no driver, e.g.
    weather, in the same pass (a left join with a membership flag).  A
    roster from ``roster_numbers`` has at most 20 rows; any other roster is
    counted first and broadcast only when small.  In streaming this is a
    stream-static join.
    """
    r = roster.select(F.col("pilot").alias(key)).distinct()
    if keep is None:
        return lines.join(bounded_broadcast(r, ROSTER_BROADCAST_ROWS), key, "left_semi")
    flagged = bounded_broadcast(r.withColumn("_member", F.lit(True)), ROSTER_BROADCAST_ROWS)
    return lines.join(flagged, key, "left").where(F.col("_member") | keep).drop("_member")
