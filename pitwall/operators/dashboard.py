"""Dashboard queries D1-D6 and their building blocks.

Every panel is a grouped aggregate, so Spark aggregates partially on each task
before the shuffle; a driver with a third of all rows costs one partial row per
task, not one task.  "Last value" (A3) is ``max_by(v, (ts, tiebreak))`` with
the ordering nulled where ``v`` is null, which is the panels' per-metric
exists-filter (P17).

Histogram buckets (A5) follow the dashboard rule: the interval is the smallest
1/2/5 x 10^k that is >= (max - min) / maxBars and >= 1.  The range comes from
one global aggregate (two numbers), computed once and used as a literal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.plans.sequence import DEFAULT_BLOCK_ROWS, lag_lead, number_rows_sized
from pitwall.schemas import TS, WEATHER_FIELDS

# Fixed values of the saved dashboard.
LINE_MAX_BARS = 167.5  # pace trace, prediction and gap panels
AUTO_MAX_BARS = 100  # "auto" bar count
SINGLE_BAR = 1  # the collapsed lap / next-lap column
RANGE_LO, RANGE_HI = 0, 1000  # range bucket [0, 1000)
ARROW = " \u2192 "  # between the bounds in the label of a range without its own
BEFORE_ALL = -(1 << 58)  # microseconds before any timestamp, for null ones
WEATHER_PANEL = ["AirTemp", "TrackTemp", "WindSpeed", "Rainfall", "Humidity"]


def nice_interval(span: float | None, max_bars: float) -> int:
    """Smallest 1/2/5 x 10^k >= span / max_bars, at least 1."""
    if span is None or span <= 0:
        return 1
    r = span / max_bars
    for e in range(0, 19):
        for m in (1, 2, 5):
            if m * 10**e >= r:
                return m * 10**e
    return 10**19


def histogram_intervals(df: DataFrame, bars: dict[str, float]) -> dict[str, int]:
    """A5 intervals for several columns from one global min/max aggregate
    (one small job returning two numbers per column)."""
    aggs = []
    for i, c in enumerate(bars):
        aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, (c, mb) in enumerate(bars.items()):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        out[c] = 1 if lo is None else nice_interval(float(hi - lo), mb)
    return out


def histogram_interval(df: DataFrame, col: str, max_bars: float) -> int:
    """A5 interval from the column's global range."""
    return histogram_intervals(df, {col: max_bars})[col]


def bucket(col: str | Column, interval: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.floor(c / interval) * interval).cast("long")


def last_value(v: str | Column, ts: str = TS, tiebreak: Sequence[str] = ()) -> Column:
    """A3: value of the latest row by ``ts`` (then tiebreak) among rows where
    the value exists.  The ordering is one fixed-width number, which keeps the
    aggregate hash-based: the timestamp's epoch microseconds or, with an
    integer tiebreak, decimal microseconds x 2*10^19 + tiebreak (nulls lowest).
    Several tiebreaks make it a struct (sort-based aggregate)."""
    c = F.col(v) if isinstance(v, str) else v
    return F.max_by(c, F.when(c.isNotNull(), moment(ts, tiebreak)))


def moment(ts: str = TS, tiebreak: Sequence[str] = ()) -> Column:
    """What ``last_value`` orders by."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    if not tiebreak:
        return micros
    if len(tiebreak) > 1:
        return F.struct(F.col(ts), *[F.col(t) for t in tiebreak])
    when = F.coalesce(micros, F.lit(BEFORE_ALL)).cast("decimal(18,0)")
    turn = F.coalesce(F.col(tiebreak[0]).cast("decimal(19,0)"), F.lit(Decimal(-(10**19) + 1)))
    return (when * F.lit(Decimal(2 * 10**19)) + turn).cast("decimal(38,0)")


@dataclass(frozen=True)
class Range:
    """A half-open range [lo, hi) of a panel; None leaves a side open."""

    lo: float | None = None
    hi: float | None = None
    own_label: str = ""

    @property
    def label(self) -> str:
        side = lambda x, open_: open_ if x is None else f"{x:g}"
        return self.own_label.strip() or side(self.lo, "-\u221e") + ARROW + side(self.hi, "\u221e")

    def holds(self, col: Column) -> Column:
        above = F.lit(True) if self.lo is None else col >= self.lo
        return col.isNotNull() & above & (F.lit(True) if self.hi is None else col < self.hi)


PANEL_RANGES = (Range(RANGE_LO, RANGE_HI),)


def range_labels(col: str | Column, ranges: Sequence[Range]) -> Column:
    """Labels of all ranges that hold the value (ranges may overlap), in
    their order; an empty array where none does or the value is null.

    The bounds, in order, cut the axis into stretches with one set of labels
    each; the stretch is found by halving, so the expression compares a value
    log2(bounds) times however many ranges a panel has."""
    c = F.col(col) if isinstance(col, str) else col
    cuts = sorted({b for r in ranges for b in (r.lo, r.hi) if b is not None})

    def labels(i: int) -> Column:
        # stretch i: from cuts[i - 1] (included) to cuts[i]
        held = [
            r.label for r in ranges
            if (r.lo is None or (i > 0 and r.lo <= cuts[i - 1])) and (r.hi is None or (i < len(cuts) and cuts[i] <= r.hi))
        ]
        return F.array(*[F.lit(x) for x in held]).cast("array<string>")

    def halve(lo: int, hi: int) -> Column:
        if lo == hi:
            return labels(lo)
        mid = (lo + hi) // 2
        return F.when(c < cuts[mid], halve(lo, mid)).otherwise(halve(mid + 1, hi))

    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(halve(0, len(cuts)))


def range_panel(df: DataFrame, key: str, x: str, value: str, key_bars: float, ranges: Sequence[Range] = PANEL_RANGES,
                tiebreak: Sequence[str] = (), collapse=F.max) -> DataFrame:
    """D2 / D4 in their tabular form: one row per ``key`` bucket, one column
    per range of ``x`` (the transposed range buckets, named by their labels)
    holding the last ``value`` of each single ``x`` bucket in the range,
    collapsed over those buckets.  All ranges are conditional aggregates of the
    same pass; rows outside every range go before it."""
    df = df.where(F.col(x).isNotNull() & F.col(key).isNotNull())
    iv = histogram_intervals(df, {x: SINGLE_BAR, key: key_bars})
    inside = df.where(F.size(range_labels(x, ranges)) > 0)
    keyed = inside.groupBy(bucket(key, iv[key]).alias("pilot_bucket"), bucket(x, iv[x]).alias("_x_bucket"))
    lasts = [last_value(F.when(r.holds(F.col(x)), F.col(value)), tiebreak=tiebreak).alias(f"_r{i}") for i, r in enumerate(ranges)]
    return keyed.agg(*lasts).groupBy("pilot_bucket").agg(*[collapse(f"_r{i}").alias(r.label) for i, r in enumerate(ranges)])


def labelled(panel: DataFrame, ranges: Sequence[Range], value: str) -> DataFrame:
    """The long form of a range panel: one row per range and key bucket, the
    range's label as a column; a bucket without a row in a range has none."""
    pairs = F.array(*[F.struct(F.lit(r.label).alias("range_label"), F.col(f"`{r.label}`").alias(value)) for r in ranges])
    return panel.select("pilot_bucket", F.inline(pairs)).where(F.col(value).isNotNull())


def in_range(col: str, lo: int = RANGE_LO, hi: int = RANGE_HI) -> Column:
    """Half-open range bucket [lo, hi)."""
    return (F.col(col) >= lo) & (F.col(col) < hi)


def time_filter(df: DataFrame, lo=None, hi=None, ts: str = TS) -> DataFrame:
    """P20: optional dashboard time range [lo, hi)."""
    if lo is not None:
        df = df.where(F.col(ts) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(ts) < F.lit(hi))
    return df


def pace_trace(laps: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None, intervals: dict[str, int] | None = None) -> DataFrame:
    """Last Seconds per (Lap bucket, PilotNumber bucket); the axis
    ``intervals`` are measured unless given."""
    laps = time_filter(laps, lo, hi).where(F.col("Lap").isNotNull() & F.col("PilotNumber").isNotNull())
    iv = intervals or histogram_intervals(laps, {"Lap": LINE_MAX_BARS, "PilotNumber": LINE_MAX_BARS})
    lap_iv, pilot_iv = iv["Lap"], iv["PilotNumber"]
    return laps.groupBy(
        bucket("Lap", lap_iv).alias("lap_bucket"), bucket("PilotNumber", pilot_iv).alias("pilot_bucket")
    ).agg(last_value("Seconds", tiebreak=tiebreak).alias("seconds"))


def race_pace_table(laps: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """D2 + T3: per PilotNumber bucket, last Seconds per single Lap bucket with
    Lap in [0, 1000), collapsed by max; faster first."""
    laps = time_filter(laps, lo, hi).where(F.col("Lap").isNotNull() & F.col("PilotNumber").isNotNull())
    ranged = laps.where(in_range("Lap"))
    iv = histogram_intervals(laps, {"Lap": SINGLE_BAR, "PilotNumber": AUTO_MAX_BARS})
    lap_iv, pilot_iv = iv["Lap"], iv["PilotNumber"]
    per_bucket = ranged.groupBy(
        bucket("PilotNumber", pilot_iv).alias("pilot_bucket"), bucket("Lap", lap_iv).alias("lap_bucket")
    ).agg(last_value("Seconds", tiebreak=tiebreak).alias("seconds"))
    return (
        per_bucket.groupBy("pilot_bucket")
        .agg(F.max("seconds").alias("seconds"))
        .orderBy(F.asc_nulls_last("seconds"), "pilot_bucket")
    )


def race_lap(laps: DataFrame, lo=None, hi=None) -> DataFrame:
    """D3 + A4: max(Lap) where Lap exists; null on empty input."""
    return time_filter(laps, lo, hi).agg(F.max("Lap").alias("race_lap"))


def prediction_table(pred: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """Per PilotN bucket, last prediction per single NextLap bucket with
    NextLap in [0, 1000), collapsed by max."""
    pred = time_filter(pred, lo, hi).where(F.col("NextLap").isNotNull() & F.col("PilotN").isNotNull())
    iv = histogram_intervals(pred, {"NextLap": SINGLE_BAR, "PilotN": LINE_MAX_BARS})
    lap_iv, pilot_iv = iv["NextLap"], iv["PilotN"]
    per_bucket = pred.where(in_range("NextLap")).groupBy(
        bucket("PilotN", pilot_iv).alias("pilot_bucket"), bucket("NextLap", lap_iv).alias("lap_bucket")
    ).agg(last_value("prediction", tiebreak=tiebreak).alias("prediction"))
    return per_bucket.groupBy("pilot_bucket").agg(F.max("prediction").alias("prediction"))


def gap_bars(gaps: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """Per Gaps.PilotNumber bucket, last interval and last gap to leader."""
    g = time_filter(gaps, lo, hi).select(
        F.col("Gaps.PilotNumber").alias("_p"),
        F.col("Gaps.IntervalToPositionAhead.Value").alias("_iv"),
        F.col("Gaps.GapToLeader").alias("_gl"),
        F.col(TS),
        *tiebreak,
    ).where(F.col("_p").isNotNull())
    pilot_iv = histogram_interval(g, "_p", LINE_MAX_BARS)
    return g.groupBy(bucket("_p", pilot_iv).alias("pilot_bucket")).agg(
        last_value("_iv", tiebreak=tiebreak).alias("gap_to_previous"),
        last_value("_gl", tiebreak=tiebreak).alias("gap_to_leader"),
    )


def weather_latest(weather: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """Global last value of five weather fields, each exists-filtered."""
    w = time_filter(weather, lo, hi)
    return w.agg(
        *[last_value(F.col(f"Weather.{f}"), tiebreak=tiebreak).alias(f) for f in WEATHER_PANEL]
    )


def unified_view(laps=None, predictions=None, gaps=None, weather=None, lo=None, hi=None) -> DataFrame:
    """U2 + P20: union of the four collections, missing columns as null, one
    flat row per document with a ``collection`` tag."""
    parts = []
    if laps is not None:
        parts.append(laps.select(F.lit("lastlaptimes").alias("collection"), TS, "PilotNumber", "Lap", "Seconds"))
    if predictions is not None:
        parts.append(
            predictions.select(F.lit("predictions").alias("collection"), TS, "PilotN", "NextLap", "prediction")
        )
    if gaps is not None:
        parts.append(
            gaps.select(
                F.lit("gaps").alias("collection"),
                TS,
                F.col("Gaps.PilotNumber").alias("gap_pilot"),
                F.col("Gaps.GapToLeader").alias("gap_to_leader"),
                F.col("Gaps.IntervalToPositionAhead.Value").alias("gap_to_previous"),
            )
        )
    if weather is not None:
        parts.append(
            weather.select(
                F.lit("others").alias("collection"),
                TS,
                *[F.col(f"Weather.{f}").alias(f) for f in WEATHER_FIELDS + ["WindDirection"]],
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return time_filter(out, lo, hi)


#: Points that one row of a gap expands to at once.
FILL_STEP = 1 << 16


def linear_fill(
    laps: DataFrame,
    key: str = "PilotNumber",
    x: str = "Lap",
    y: str = "Seconds",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    every: int = 1,
) -> DataFrame:
    """Every ``x`` on the axis (multiples of ``every``) from each key's
    first to last known point, with ``y`` linearly interpolated between
    neighbouring known points; rows without a ``y`` are no points.

    Each known point is paired with the next one (a lead over a skew-safe per
    key numbering) and expands only its own segment, so no task builds a whole
    key's grid; a long segment is cut into steps of ``FILL_STEP`` points before
    they are made, so no row ever holds more.  Returns ``key, x, y, known``.
    """
    pts = laps.where(F.col(key).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(key, x).agg(
        F.max(y).alias(y)
    )
    numbered, longest = number_rows_sized(pts, [key], [x], "_rn")
    paired = lag_lead(numbered, [key], "_rn", {"_x2": (x, -1), "_y2": (y, -1)}, block_rows, longest)
    x1, x2 = F.col("_x1"), F.col("_x2")
    # points of the segment: this known one and those before the next
    points = F.coalesce(F.floor((x2 - x1 - 1) / every) + 1, F.lit(1)).cast("long")
    steps = (
        paired.select(key, F.col(x).cast("long").alias("_x1"), F.col(y).alias("_y1"), F.col("_x2").cast("long").alias("_x2"), "_y2")
        .withColumn("_points", points)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_points") - 1, F.lit(FILL_STEP).cast("long"))))
    )
    last = F.least(F.col("_from") + FILL_STEP, F.col("_points")) - 1
    grid = steps.withColumn("_i", F.explode(F.sequence(F.col("_from"), last)))
    at = x1 + F.col("_i") * every
    frac = (at - x1) / (x2 - x1)
    val = F.when(F.col("_i") == 0, F.col("_y1")).otherwise(F.col("_y1") + (F.col("_y2") - F.col("_y1")) * frac)
    kind = laps.schema[x].dataType
    return grid.select(key, at.cast(kind).alias(x), val.alias(y), (F.col("_i") == 0).alias("known"))


def pace_trace_fitted(laps: DataFrame, tiebreak: Sequence[str] = (), lo=None, hi=None) -> DataFrame:
    """D1 as drawn: the pace trace with a straight line across lap buckets that
    a driver bucket lacks (fitting "linear"); ``known`` marks measured ones."""
    laps = time_filter(laps, lo, hi).where(F.col("Lap").isNotNull() & F.col("PilotNumber").isNotNull())
    iv = histogram_intervals(laps, {"Lap": LINE_MAX_BARS, "PilotNumber": LINE_MAX_BARS})
    trace = pace_trace(laps, tiebreak, intervals=iv)
    return linear_fill(trace, key="pilot_bucket", x="lap_bucket", y="seconds", every=iv["Lap"])
