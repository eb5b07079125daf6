"""Scalar column functions.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none needs a Python worker.  Spark 4 runs with ANSI casts, so every
text conversion goes through ``try_cast`` and malformed text becomes null
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the feed format.
LEADING_NUMBER = r"^\s*[+-]?[0-9]*\.?[0-9]+"  # what a text->float conversion keeps
ISO_CLOCK = r"T(\d{2}):(\d{2}):(\d{2})(\.(\d+))?"  # wall clock inside an ISO time
PY_LITERALS = (("True", "true"), ("False", "false"), ("None", "null"))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lap_text_to_seconds(text) -> Column:
    """"m:ss.fff" -> m*60 + ss.fff as DOUBLE.

    Only the first two ':'-parts are read ("1:02:03" -> 62.0).  Text without
    ':' falls back to a plain numeric cast ("58.1" -> 58.1, "" -> null); any
    malformed part gives null.
    """
    t = _c(text)
    parts = F.split(t, ":", -1)
    minutes = F.try_element_at(parts, F.lit(1)).try_cast("int")
    secs = _plain_double(F.try_element_at(parts, F.lit(2)))
    return F.when(F.size(parts) >= 2, minutes * 60 + secs).otherwise(_plain_double(t))


def _plain_double(text) -> Column:
    """Numeric cast without the type suffixes ("18.2f") that a cast accepts."""
    return F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))


def text_to_double(text) -> Column:
    """F2: leading number of a text as DOUBLE ("+12.3" -> 12.3, "1 LAP" -> 1.0,
    "LAP 1" / "" -> null)."""
    return F.regexp_extract(_c(text), LEADING_NUMBER, 0).try_cast("double")


def text_to_int(text) -> Column:
    """leading number truncated toward zero as INT."""
    d = text_to_double(text)
    return F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).try_cast("int")


def seconds_to_lap_text(seconds) -> Column:
    """Inverse of F1 for building feed text: 78.234 -> "1:18.234"."""
    s = _c(seconds)
    m = F.floor(s / 60)
    return F.format_string("%d:%06.3f", m, s - m * 60)


def iso_clock_millis(iso_text) -> Column:
    """F4+F5 on integers: wall clock of an ISO time as HHMMSS with milliseconds,
    returned as a LONG count of 1/1000 units (130312.123 -> 130312123).

    The digits are read straight from the text, like the feed replayer, so a
    minute boundary adds 40 seconds' worth of clock number.  The fraction is
    rounded half-up to milliseconds with integer arithmetic, so every engine
    agrees bit for bit.
    """
    t = _c(iso_text)
    h = F.regexp_extract(t, ISO_CLOCK, 1).try_cast("long")
    mi = F.regexp_extract(t, ISO_CLOCK, 2).try_cast("long")
    s = F.regexp_extract(t, ISO_CLOCK, 3).try_cast("long")
    frac = F.rpad(F.regexp_extract(t, ISO_CLOCK, 5), 6, "0").substr(1, 6).try_cast("long")
    micros = ((h * 10000 + mi * 100 + s) * 1000000) + frac
    return F.when(h.isNotNull(), F.floor((micros + 500) / 1000).cast("long"))


def instant_millis(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP, rounded half-up from microseconds."""
    return F.floor((F.unix_micros(_c(ts)) + 500) / 1000).cast("long")


ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def utc_instant(ntz) -> Column:
    """TIMESTAMP_NTZ holding UTC wall-clock time -> TIMESTAMP (an instant),
    whatever the session time zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(ntz)).cast("timestamp")


def iso_utc(ts) -> Column:
    """TIMESTAMP -> ISO-8601 text in UTC with a 'Z' suffix, whatever the
    session time zone is."""
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))
    return F.date_format(wall, ISO_UTC_FORMAT)


def iso_to_timestamp(iso_text) -> Column:
    """ISO-8601 text (with zone) -> TIMESTAMP; malformed -> null."""
    return F.try_to_timestamp(_c(iso_text))


def round3(x) -> Column:
    """round to 3 decimals."""
    return F.round(_c(x), 3)


def py_literal_to_json(text) -> Column:
    """a host-language literal payload ({'a': True, 'b': None}) rewritten so
    that ``from_json`` (which accepts single quotes) can read it.  Whole-word
    True/False/None are replaced, which may also touch free text."""
    t = _c(text)
    for word, js in PY_LITERALS:
        t = F.regexp_replace(t, rf"\b{word}\b", js)
    return t


def contains(text, needle: str) -> Column:
    """substring test, ``find(x) != -1``."""
    return F.instr(_c(text), needle) > 0


def json_split_points(text) -> Column:
    """split concatenated JSON at every "}{" boundary (zero width)."""
    return F.split(_c(text), r"(?<=\})(?=\{)")


def brace_balance(text) -> Column:
    """count('{') - count('}') of a text outside its quoted values (used to
    repair split JSON records)."""
    t = F.regexp_replace(_c(text), r'"(?:[^"\\]++|\\.)*+"', "")
    return (F.length(t) - F.length(F.regexp_replace(t, r"\{", ""))) - (
        F.length(t) - F.length(F.regexp_replace(t, r"\}", ""))
    )
