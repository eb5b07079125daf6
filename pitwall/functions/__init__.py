from pitwall.functions.scalars import (  # noqa: F401
    brace_balance,
    contains,
    instant_millis,
    iso_clock_millis,
    iso_to_timestamp,
    json_split_points,
    lap_text_to_seconds,
    py_literal_to_json,
    round3,
    seconds_to_lap_text,
    text_to_double,
    text_to_int,
)
