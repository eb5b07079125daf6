"""Independent DuckDB SQL for every registered query (same column names).

The tables ``events`` etc. are views over the same parquet files.  Each SQL
computes the expected rows straight from the tables with plain window
functions and aggregates -- none of the engine's feed text, JSON parsing or
skew-safe plans -- so a match checks the whole Spark path.
"""

from __future__ import annotations

MS = "((epoch_us(ts) + 500) // 1000)"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Laps of the test mapping: every event, numbered per user.
LAPS = """laps AS (
  SELECT CAST(user_id AS INTEGER) AS PilotNumber,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS Lap,
         value AS Seconds, ts, event_id, event_type, props
  FROM events)"""
# Laps that reach the lap stream (timing lines with a lap time).
FLAPS = "flaps AS (SELECT * FROM laps WHERE event_type IN ('click', 'view'))"
ROUTE = (
    "CASE WHEN event_type IN ('click', 'view') THEN 'lap' WHEN event_type = 'purchase' THEN 'gap' "
    "WHEN event_type = 'error' THEN 'weather' ELSE 'none' END"
)
ROSTER = """firsts AS (SELECT CAST(user_id AS INTEGER) AS pilot, min(ts) AS f FROM events GROUP BY user_id),
doc AS (SELECT pilot, CAST(row_number() OVER (ORDER BY f, pilot) - 1 AS INTEGER) AS pos FROM firsts),
roster AS (SELECT pos, CASE WHEN pilot = 33 THEN 1 ELSE pilot END AS pilot FROM doc WHERE pos < 20)"""


def nice(span_sql: str, max_bars: float) -> str:
    """Smallest 1/2/5 x 10^k >= span / max_bars, at least 1."""
    return (
        "(SELECT coalesce(min(c), 1) FROM (SELECT m * pow(10, e) AS c "
        "FROM (VALUES (1), (2), (5)) AS a(m), range(0, 19) AS b(e)) AS q "
        f"WHERE c >= ({span_sql}) / {max_bars})"
    )


def bucket(col: str, iv: str) -> str:
    return f"CAST(floor({col} / {iv}) * {iv} AS BIGINT)"


def rolling(src: str, n: int = 10, cadence: int = 2, reg: float = 0.01) -> str:
    """CTEs ending in ``pred(PilotNumber, Lap, NextLap, prediction, ts, event_id)``."""
    return f"""win AS (
  SELECT PilotNumber, Lap, ts, event_id,
         covar_pop(Lap, Seconds) OVER w AS cxy, var_pop(Lap) OVER w AS vx,
         stddev_pop(Seconds) OVER w AS sy, avg(Lap) OVER w AS mx, avg(Seconds) OVER w AS my,
         max(Lap) OVER w + 1 AS NextLap,
         row_number() OVER (PARTITION BY PilotNumber ORDER BY Lap, ts, event_id) AS k
  FROM {src}
  WINDOW w AS (PARTITION BY PilotNumber ORDER BY Lap, ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)),
fit AS (
  SELECT *, CASE WHEN vx > 0 AND sy > 0 THEN cxy / vx / (1 + {reg} / sy) ELSE 0 END AS slope FROM win),
model AS (
  SELECT *, my - slope * mx AS intercept,
         (NextLap % {cadence} = 0 OR NextLap < 6 OR k = 1) AS refit FROM fit),
carried AS (
  SELECT *,
         last_value(CASE WHEN refit THEN slope END IGNORE NULLS) OVER c AS s,
         last_value(CASE WHEN refit THEN intercept END IGNORE NULLS) OVER c AS i
  FROM model
  WINDOW c AS (PARTITION BY PilotNumber ORDER BY Lap, ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pred AS (
  SELECT PilotNumber, Lap, CAST(NextLap AS INTEGER) AS NextLap, s * NextLap + i AS prediction, ts, event_id
  FROM carried)"""


def rolling_prediction_sql(n: int, cadence: int) -> str:
    return f"""WITH {LAPS},
{rolling('laps', n, cadence)}
SELECT PilotNumber, NextLap, round(prediction, 4) AS prediction FROM pred"""


def arrival_sql(n: int = 10, cadence: int = 2, reg: float = 0.01) -> str:
    """Laps in arrival order: the n highest laps of all that have come."""
    return f"""WITH {LAPS},
late AS (SELECT PilotNumber, CAST(CASE WHEN (Lap - 1) % 6 = 0 THEN Lap + 5 ELSE Lap - 1 END AS INTEGER) AS Lap, Seconds, ts, event_id
         FROM laps),
a AS (SELECT *, row_number() OVER (PARTITION BY PilotNumber ORDER BY ts, Lap, event_id) AS k FROM late),
seen AS (SELECT *, list({{'l': Lap, 't': ts, 'k': k, 's': Seconds}}) OVER (
           PARTITION BY PilotNumber ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS arrived FROM a),
top AS (SELECT PilotNumber, Lap, k, unnest(list_slice(list_reverse_sort(arrived), 1, {n})) AS e FROM seen),
win AS (SELECT PilotNumber, Lap, k, covar_pop(e.l, e.s) AS cxy, var_pop(e.l) AS vx, stddev_pop(e.s) AS sy, avg(e.l) AS mx, avg(e.s) AS my,
               max(e.l) + 1 AS NextLap FROM top GROUP BY PilotNumber, Lap, k),
fit AS (SELECT *, CASE WHEN vx > 0 AND sy > 0 THEN cxy / vx / (1 + {reg} / sy) ELSE 0 END AS slope FROM win),
model AS (SELECT *, my - slope * mx AS intercept, (NextLap % {cadence} = 0 OR NextLap < 6 OR k = 1) AS refit FROM fit),
carried AS (
  SELECT *, last_value(CASE WHEN refit THEN slope END IGNORE NULLS) OVER c AS s,
            last_value(CASE WHEN refit THEN intercept END IGNORE NULLS) OVER c AS i
  FROM model WINDOW c AS (PARTITION BY PilotNumber ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT PilotNumber, Lap, CAST(NextLap AS INTEGER) AS NextLap, round(s * NextLap + i, 4) AS prediction FROM carried"""


def ranges_sql(src: str, key: str, x: str, value: str, order: str, key_bars: float) -> str:
    """CTEs ending in one row per key bucket with the two ranges' values."""
    last = lambda cond, name: (
        f"{name} AS (SELECT pilot_bucket, max({value}) AS v FROM "
        + last_rows(f"(SELECT * FROM b WHERE {cond})", "pilot_bucket, lap_bucket", order)
        + " GROUP BY pilot_bucket)"
    )
    return f"""iv AS (SELECT {nice(f'SELECT max({x}) - min({x}) FROM {src}', 1)} AS lap_iv,
              {nice(f'SELECT max({key}) - min({key}) FROM {src}', key_bars)} AS pilot_iv),
b AS (SELECT {bucket(key, 'pilot_iv')} AS pilot_bucket, {bucket(x, 'lap_iv')} AS lap_bucket, {src}.* FROM {src}, iv
      WHERE {value} IS NOT NULL),
{last(f'{x} >= 0 AND {x} < 40', 'early')},
{last(f'{x} >= 20 AND {x} < 1000', 'later')}"""


def buffer_sql(n: int) -> str:
    return f"""WITH {LAPS},
r AS (SELECT PilotNumber, Lap, Seconds,
             row_number() OVER (PARTITION BY PilotNumber ORDER BY Lap DESC, ts DESC) AS pos FROM laps)
SELECT PilotNumber, Lap, round(Seconds, 4) AS Seconds, CAST(pos AS INTEGER) AS buffer_pos FROM r WHERE pos <= {n}"""


BUFFER_FIT = f"""{LAPS},
buf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PilotNumber ORDER BY Lap DESC, ts DESC) AS pos
                       FROM laps) WHERE pos <= 10),
g AS (SELECT PilotNumber, covar_pop(Lap, Seconds) AS cxy, var_pop(Lap) AS vx, stddev_pop(Seconds) AS sy,
             avg(Lap) AS mx, avg(Seconds) AS my, max(Lap) AS ml, count(*) AS n_laps
      FROM buf GROUP BY PilotNumber),
f AS (SELECT *, CASE WHEN vx > 0 AND sy > 0 THEN cxy / vx / (1 + 0.01 / sy) ELSE 0 END AS slope FROM g)"""

INTERARRIVAL = """WITH m AS (SELECT event_id, CAST(user_id AS INTEGER) AS PilotNumber, ts, {t} AS t FROM events),
d AS (SELECT event_id, PilotNumber,
             (t - lag(t) OVER (PARTITION BY PilotNumber ORDER BY ts, event_id)) / 1000.0 AS delta FROM m)"""
CLOCK_MS = (
    "((CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS BIGINT) * 1000000 "
    "+ epoch_us(ts) % 1000000 + 500) // 1000)"
)


def last_rows(src: str, part: str, order: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rk FROM {src}) WHERE rk = 1)"


ORACLE: dict[str, str] = {
    "rolling_lap_prediction": rolling_prediction_sql(10, 2),
    "rolling_lap_prediction_n5": rolling_prediction_sql(5, 5),
    "lap_buffer_top10": buffer_sql(10),
    "lap_buffer_top5": buffer_sql(5),
    "next_lap_per_driver": f"""WITH {LAPS}
SELECT PilotNumber, CAST(max(Lap) + 1 AS INTEGER) AS NextLap FROM laps GROUP BY PilotNumber""",
    "driver_ridge_fit": f"""WITH {BUFFER_FIT}
SELECT PilotNumber, round(slope, 4) AS slope, round(my - slope * mx, 4) AS intercept,
       CAST(ml + 1 AS INTEGER) AS NextLap, n_laps FROM f""",
    "driver_score_join": f"""WITH {BUFFER_FIT}
SELECT PilotNumber, CAST(ml + 1 AS INTEGER) AS NextLap,
       round(slope * (ml + 1) + (my - slope * mx), 4) AS prediction FROM f""",
    "parse_lap_value": f"""WITH {LAPS}
SELECT PilotNumber, Lap, round(Seconds, 4) AS Seconds, {MS} AS ts_ms FROM laps WHERE event_type = 'click'""",
    "lap_text_to_seconds": """SELECT event_id, round(value, 4) AS from_clock, round(value, 4) AS from_plain,
       CAST(NULL AS DOUBLE) AS malformed FROM events""",
    "numeric_convert": f"""SELECT event_id, round(value, 4) AS gap, round(CAST({K} AS DOUBLE), 4) AS laps_behind,
       CAST(NULL AS DOUBLE) AS no_number, round(-value, 4) AS negative, CAST({K} * 10 AS INTEGER) AS wind
FROM events""",
    "clock_number": f"SELECT event_id, {CLOCK_MS} / 1000.0 AS clock FROM events",
    "feed_filter": """SELECT kind, count(*) AS n FROM (
  SELECT 'feed' AS kind FROM events
  UNION ALL SELECT 'recap' FROM events WHERE event_type = 'signup'
  UNION ALL SELECT 'empty' FROM events WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT 'text' FROM events WHERE event_type = 'view') GROUP BY kind""",
    "route_counts": f"SELECT route, count(*) AS n FROM (SELECT {ROUTE} AS route FROM events) GROUP BY route",
    "roster_normalise": f"WITH {ROSTER} SELECT pos, pilot FROM roster",
    "line_fanout": f"""WITH {ROSTER}
SELECT event_id, CAST(user_id AS INTEGER) AS PilotNumber, {ROUTE} AS route FROM events
WHERE event_type <> 'error' AND CAST(user_id AS INTEGER) IN (SELECT pilot FROM roster)""",
    "best_lap_gate": """SELECT event_id, CAST(user_id AS INTEGER) AS PilotNumber, 'lap' AS route
FROM events WHERE event_type = 'click'""",
    "recap_lines": f"""WITH {LAPS}
SELECT event_id, PilotNumber, Lap, round(Seconds, 4) AS recap_seconds, CAST(NULL AS DOUBLE) AS Seconds,
       'lap' AS route FROM laps WHERE event_type = 'signup'""",
    "concat_json_split": f"""SELECT 'feed' AS kind,
       CASE WHEN event_type = 'error' THEN 'WeatherData' ELSE 'TimingData' END AS topic,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS DOUBLE) END AS PilotNumber,
       CAST({MS} AS DOUBLE) AS ts_ms FROM events
UNION ALL SELECT 'recap', NULL, CAST(user_id AS DOUBLE), NULL FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'empty', NULL, NULL, NULL FROM events WHERE event_type IN ('purchase', 'error')""",
    "literal_payload_parse": f"""WITH {LAPS}
SELECT PilotNumber, Lap, round(Seconds, 4) AS Seconds, event_type = 'click' AS fastest,
       CAST(NULL AS VARCHAR) AS retired FROM laps WHERE event_type IN ('click', 'view')""",
    "interarrival_gap": INTERARRIVAL.format(t=MS) + "\nSELECT event_id, PilotNumber, round(delta, 4) AS delta FROM d",
    "interarrival_clock": INTERARRIVAL.format(t=CLOCK_MS)
    + "\nSELECT event_id, PilotNumber, round(delta, 4) AS delta FROM d",
    "bounded_gap_filter": INTERARRIVAL.format(t=MS)
    + "\nSELECT event_id, PilotNumber, round(delta, 4) AS delta FROM d WHERE delta > 0 AND delta <= 7200",
    "pace_trace": f"""WITH {LAPS}, {FLAPS},
iv AS (SELECT {nice('SELECT max(Lap) - min(Lap) FROM flaps', 167.5)} AS lap_iv,
              {nice('SELECT max(PilotNumber) - min(PilotNumber) FROM flaps', 167.5)} AS pilot_iv),
b AS (SELECT {bucket('Lap', 'lap_iv')} AS lap_bucket, {bucket('PilotNumber', 'pilot_iv')} AS pilot_bucket,
             Seconds, ts, event_id FROM flaps, iv WHERE Seconds IS NOT NULL)
SELECT lap_bucket, pilot_bucket, round(Seconds, 4) AS seconds
FROM {last_rows('b', 'lap_bucket, pilot_bucket', 'ts DESC, event_id DESC')}""",
    "pace_trace_filled": f"""WITH {LAPS},
l3 AS (SELECT PilotNumber, Lap * 3 AS Lap, Seconds FROM laps),
rng AS (SELECT PilotNumber, min(Lap) AS lo, max(Lap) AS hi FROM l3 GROUP BY PilotNumber),
grid AS (SELECT PilotNumber, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS Lap FROM rng),
j AS (SELECT g.PilotNumber, g.Lap, l.Seconds, CASE WHEN l.Lap IS NOT NULL THEN g.Lap END AS kx
      FROM grid g LEFT JOIN l3 l ON g.PilotNumber = l.PilotNumber AND g.Lap = l.Lap),
f AS (SELECT *, last_value(kx IGNORE NULLS) OVER p AS x1, last_value(Seconds IGNORE NULLS) OVER p AS y1,
             first_value(kx IGNORE NULLS) OVER q AS x2, first_value(Seconds IGNORE NULLS) OVER q AS y2
      FROM j
      WINDOW p AS (PARTITION BY PilotNumber ORDER BY Lap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             q AS (PARTITION BY PilotNumber ORDER BY Lap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT PilotNumber, Lap,
       round(CASE WHEN Lap = x1 THEN y1 ELSE y1 + (y2 - y1) * ((Lap - x1) / (x2 - x1)) END, 4) AS Seconds,
       Lap = x1 AS known
FROM f""",
    "race_pace_table": f"""WITH {LAPS}, {FLAPS},
iv AS (SELECT {nice('SELECT max(Lap) - min(Lap) FROM flaps', 1)} AS lap_iv,
              {nice('SELECT max(PilotNumber) - min(PilotNumber) FROM flaps', 100)} AS pilot_iv),
b AS (SELECT {bucket('PilotNumber', 'pilot_iv')} AS pilot_bucket, {bucket('Lap', 'lap_iv')} AS lap_bucket,
             Seconds, ts, event_id FROM flaps, iv WHERE Lap >= 0 AND Lap < 1000 AND Seconds IS NOT NULL)
SELECT pilot_bucket, round(max(Seconds), 4) AS seconds
FROM {last_rows('b', 'pilot_bucket, lap_bucket', 'ts DESC, event_id DESC')} GROUP BY pilot_bucket""",
    "pace_trace_fitted": f"""WITH {LAPS},
fl AS (SELECT PilotNumber, Lap * 7 AS Lap, Seconds, ts, event_id FROM laps WHERE event_type IN ('click', 'view')),
iv AS (SELECT {nice('SELECT max(Lap) - min(Lap) FROM fl', 167.5)} AS lap_iv,
              {nice('SELECT max(PilotNumber) - min(PilotNumber) FROM fl', 167.5)} AS pilot_iv),
b AS (SELECT {bucket('Lap', 'lap_iv')} AS lap_bucket, {bucket('PilotNumber', 'pilot_iv')} AS pilot_bucket,
             Seconds, ts, event_id FROM fl, iv WHERE Seconds IS NOT NULL),
t AS (SELECT lap_bucket, pilot_bucket, Seconds FROM {last_rows('b', 'lap_bucket, pilot_bucket', 'ts DESC, event_id DESC')}),
rng AS (SELECT pilot_bucket, min(lap_bucket) AS lo, max(lap_bucket) AS hi FROM t GROUP BY pilot_bucket),
grid AS (SELECT pilot_bucket, unnest(generate_series(lo, hi, CAST(lap_iv AS BIGINT))) AS lap_bucket FROM rng, iv),
j AS (SELECT g.pilot_bucket, g.lap_bucket, t.Seconds, CASE WHEN t.lap_bucket IS NOT NULL THEN g.lap_bucket END AS kx
      FROM grid g LEFT JOIN t ON g.pilot_bucket = t.pilot_bucket AND g.lap_bucket = t.lap_bucket),
f AS (SELECT *, last_value(kx IGNORE NULLS) OVER p AS x1, last_value(Seconds IGNORE NULLS) OVER p AS y1,
             first_value(kx IGNORE NULLS) OVER q AS x2, first_value(Seconds IGNORE NULLS) OVER q AS y2
      FROM j
      WINDOW p AS (PARTITION BY pilot_bucket ORDER BY lap_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             q AS (PARTITION BY pilot_bucket ORDER BY lap_bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT lap_bucket, pilot_bucket,
       round(CASE WHEN lap_bucket = x1 THEN y1 ELSE y1 + (y2 - y1) * ((lap_bucket - x1) / (x2 - x1)) END, 9) AS seconds,
       lap_bucket = x1 AS known
FROM f""",
    "late_lap_prediction": arrival_sql(),
    "stream_late_laps": arrival_sql(),
    "race_pace_two_ranges": f"""WITH {LAPS}, {FLAPS},
{ranges_sql('flaps', 'PilotNumber', 'Lap', 'Seconds', 'ts DESC, event_id DESC', 100)}
SELECT pilot_bucket, round(early.v, 4) AS early, round(later.v, 4) AS from_20 FROM early FULL JOIN later USING (pilot_bucket)""",
    "prediction_two_ranges": f"""WITH {LAPS}, {FLAPS},
{rolling('flaps')},
{ranges_sql('pred', 'PilotNumber', 'NextLap', 'prediction', 'ts DESC, NextLap DESC, PilotNumber DESC', 167.5)}
SELECT 'early' AS range_label, pilot_bucket, round(v, 4) AS prediction FROM early
UNION ALL SELECT '20 \u2192 1000', pilot_bucket, round(v, 4) FROM later""",
    "race_lap": f"WITH {LAPS}, {FLAPS} SELECT max(Lap) AS race_lap FROM flaps",
    "prediction_table": f"""WITH {LAPS}, {FLAPS},
{rolling('flaps')},
iv AS (SELECT {nice('SELECT max(NextLap) - min(NextLap) FROM pred', 1)} AS lap_iv,
              {nice('SELECT max(PilotNumber) - min(PilotNumber) FROM pred', 167.5)} AS pilot_iv),
b AS (SELECT {bucket('PilotNumber', 'pilot_iv')} AS pilot_bucket, {bucket('NextLap', 'lap_iv')} AS lap_bucket,
             prediction, ts, NextLap, PilotNumber FROM pred, iv
      WHERE NextLap >= 0 AND NextLap < 1000 AND prediction IS NOT NULL)
SELECT pilot_bucket, round(max(prediction), 4) AS prediction
FROM {last_rows('b', 'pilot_bucket, lap_bucket', 'ts DESC, NextLap DESC, PilotNumber DESC')}
GROUP BY pilot_bucket""",
    "gap_bars": f"""WITH g AS (SELECT CAST(user_id AS INTEGER) AS p, value AS gl, {K} / 10.0 AS gp, ts, event_id
           FROM events WHERE event_type = 'purchase'),
iv AS (SELECT {nice('SELECT max(p) - min(p) FROM g', 167.5)} AS piv),
b AS (SELECT {bucket('p', 'piv')} AS pilot_bucket, gl, gp, ts, event_id FROM g, iv)
SELECT pilot_bucket, round(gp, 4) AS gap_to_previous, round(gl, 4) AS gap_to_leader
FROM {last_rows('b', 'pilot_bucket', 'ts DESC, event_id DESC')}""",
    "weather_latest": f"""WITH w AS (
  SELECT value AS AirTemp, value + 10 AS TrackTemp, {K} / 10.0 AS WindSpeed,
         CAST(CASE WHEN {K} >= 50 THEN 1 ELSE 0 END AS DOUBLE) AS Rainfall, CAST({K} AS DOUBLE) AS Humidity, ts, event_id
  FROM events WHERE event_type = 'error'),
top AS (SELECT * FROM w ORDER BY ts DESC, event_id DESC LIMIT 1)
SELECT round(top.AirTemp, 4) AS AirTemp, round(top.TrackTemp, 4) AS TrackTemp, round(top.WindSpeed, 4) AS WindSpeed,
       round(top.Rainfall, 4) AS Rainfall, round(top.Humidity, 4) AS Humidity
FROM (SELECT 1 AS one) d LEFT JOIN top ON true""",
    "unified_view": f"""WITH {LAPS}, {FLAPS},
{rolling('flaps')}
SELECT 'lastlaptimes' AS collection, {MS} AS ts_ms, CAST(PilotNumber AS DOUBLE) AS PilotNumber, CAST(Lap AS DOUBLE) AS Lap, CAST(NULL AS DOUBLE) AS PilotN,
       CAST(NULL AS DOUBLE) AS NextLap, CAST(NULL AS DOUBLE) AS gap_pilot, CAST(NULL AS DOUBLE) AS WindDirection,
       round(Seconds, 4) AS Seconds, CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS DOUBLE) AS gap_to_leader,
       CAST(NULL AS DOUBLE) AS gap_to_previous, CAST(NULL AS DOUBLE) AS AirTemp, CAST(NULL AS DOUBLE) AS Humidity,
       CAST(NULL AS DOUBLE) AS Pressure, CAST(NULL AS DOUBLE) AS Rainfall, CAST(NULL AS DOUBLE) AS TrackTemp,
       CAST(NULL AS DOUBLE) AS WindSpeed
FROM flaps
UNION ALL
SELECT 'predictions', {MS}, NULL, NULL, CAST(PilotNumber AS DOUBLE), CAST(NextLap AS DOUBLE), NULL, NULL,
       NULL, round(prediction, 4), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM pred
UNION ALL
SELECT 'gaps', {MS}, NULL, NULL, NULL, NULL, CAST(user_id AS DOUBLE), NULL,
       NULL, NULL, round(value, 4), round({K} / 10.0, 4), NULL, NULL, NULL, NULL, NULL, NULL
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT 'others', {MS}, NULL, NULL, NULL, NULL, NULL, CAST({K} * 3 AS DOUBLE),
       NULL, NULL, NULL, NULL, round(value, 4), round(CAST({K} AS DOUBLE), 4), round(1000 + {K} / 10.0, 4),
       CAST(CASE WHEN {K} >= 50 THEN 1 ELSE 0 END AS DOUBLE), round(value + 10, 4), round({K} / 10.0, 4)
FROM events WHERE event_type = 'error'""",
    "keyed_json_sink": f"""WITH {LAPS}, {FLAPS}
SELECT 'info' AS key, PilotNumber, Lap, round(Seconds, 4) AS Seconds, {MS} AS ts_ms FROM flaps""",
    "lap_histogram": f"""WITH {LAPS}, {FLAPS},
iv AS (SELECT {nice('SELECT max(Lap) - min(Lap) FROM flaps', 167.5)} AS lap_iv)
SELECT {bucket('Lap', 'lap_iv')} AS lap_bucket, count(*) AS n FROM flaps, iv
GROUP BY 1""",
    "stream_rolling_prediction": rolling_prediction_sql(10, 2),
    "stream_latest_value": f"""WITH {LAPS}
SELECT PilotNumber, round(max_by(Seconds, ts), 4) AS seconds, max(Lap) AS Lap FROM laps GROUP BY PilotNumber""",
    "stream_three_way_split": """SELECT collection, count(*) AS n FROM (
  SELECT CASE WHEN event_type IN ('click', 'view') THEN 'lastlaptimes' WHEN event_type = 'purchase' THEN 'gaps'
              ELSE 'others' END AS collection
  FROM events WHERE event_type <> 'signup') GROUP BY collection""",
    "stream_bronze_capture": """SELECT kind, count(*) AS n FROM (
  SELECT 'feed' AS kind FROM events
  UNION ALL SELECT 'recap' FROM events WHERE event_type = 'signup'
  UNION ALL SELECT 'empty' FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT 'text' FROM events WHERE event_type = 'view') GROUP BY kind""",
    "replay_schedule": INTERARRIVAL.format(t=MS)
    + """
SELECT event_id, 0 AS part, 'feed' AS kind, round(delta, 4) AS delta, coalesce(delta > 0 AND delta <= 7200, false) AS sent
FROM d
UNION ALL SELECT event_id, 1, 'recap', CAST(0.001 AS DOUBLE), true FROM events WHERE event_type = 'signup'
UNION ALL SELECT event_id, 1, 'empty', CAST(0.001 AS DOUBLE), true FROM events WHERE event_type IN ('purchase', 'error')""",
    "stream_live_system": f"""WITH {LAPS}, {FLAPS},
{rolling('flaps')}
SELECT PilotNumber, NextLap, round(prediction, 4) AS prediction FROM pred""",
    "interarrival_global": f"""WITH m AS (SELECT event_id, ts, {MS} AS t FROM events)
SELECT event_id, round((t - lag(t) OVER (ORDER BY ts, event_id)) / 1000.0, 4) AS delta FROM m""",
}
ORACLE["race_pace_labelled"] = f"SELECT '0 \u2192 1000' AS range_label, pilot_bucket, seconds FROM ({ORACLE['race_pace_table']})"
# The wildcard view: four collections, and the older job's predictions as floats.
ORACLE["unified_view_pattern"] = f"""WITH {LAPS}, {FLAPS},
older AS (WITH {rolling('flaps', 5, 5)} SELECT * FROM pred)
SELECT collection, ts_ms, PilotNumber, Lap, PilotN, NextLap, Seconds, prediction, gap_to_leader, AirTemp
FROM ({ORACLE['unified_view']})
UNION ALL
SELECT 'predictions-older', {MS}, NULL, NULL, CAST(PilotNumber AS DOUBLE), CAST(NextLap AS DOUBLE), NULL,
       round(CAST(CAST(prediction AS FLOAT) AS DOUBLE), 4), NULL, NULL
FROM older"""

# Streamed panels equal the batch panels.
for _panel in ("race_pace_table", "prediction_table", "gap_bars", "weather_latest"):
    ORACLE[f"stream_{_panel}"] = ORACLE[_panel]
_SPLIT = f"""SELECT * EXCLUDE (PilotN, NextLap, prediction) FROM ({ORACLE['unified_view']}) WHERE collection <> 'predictions'"""
ORACLE["stream_split_contents"] = _SPLIT
ORACLE["dashboards_time_range"] = f"""SELECT * FROM ({_SPLIT})
WHERE ts_ms >= epoch_ms(TIMESTAMP '2024-01-08 00:00:00') AND ts_ms < epoch_ms(TIMESTAMP '2024-01-15 12:00:00')"""
# Two sessions: the parity of the event id; a driver's key holds both.
ORACLE["stream_two_sessions"] = f"""WITH {LAPS}, {FLAPS},
sess AS (SELECT CAST(PilotNumber * 2 + event_id % 2 AS INTEGER) AS PilotNumber, Lap, Seconds, ts, event_id FROM flaps),
{rolling('sess')}
SELECT CAST(PilotNumber % 2 AS INTEGER) AS session, CAST(PilotNumber // 2 AS INTEGER) AS PilotNumber, Lap, NextLap,
       round(CAST(CAST(prediction AS FLOAT) AS DOUBLE), 4) AS prediction, {MS} AS ts_ms, true AS stamped
FROM pred"""
ORACLE["stream_bus_records"] = ORACLE["keyed_json_sink"]
