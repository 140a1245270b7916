"""DuckDB SQL that computes each query's result independently from the same tables.

The SQL is put together from common table expressions, as most queries share the derived inputs.
Forests are trained on steps of the hour, which they learn exactly, so their outcome has an SQL form too.
"""

from __future__ import annotations

from wxspark.constants import ATTRIBUTES, CITIES, REGIMES, TARGETS, UNITS
from wxspark.plans import train
from wxspark.sources import generate

ORACLES: dict[str, str] = {}

# The 64-bit xxHash of a long, in 128-bit arithmetic cut to 64 bits. Its published constants:
_P1, _P2, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
_P3 = 0x165667B19E3779F9
_MASK = (1 << 64) - 1


def _rotate(value: int, bits: int) -> int:
    return (value << bits | value >> 64 - bits) & _MASK


def _hash_long(value: int, seed: int) -> int:
    mixed = _rotate(value * _P2 & _MASK, 31) * _P1 & _MASK
    state = _rotate((seed + _P5 + 8 & _MASK) ^ mixed, 27) * _P1 + _P4 & _MASK
    for shift, factor in ((33, _P2), (29, _P3), (32, 1)):
        state = (state ^ state >> shift) * factor & _MASK
    return state


def _u(number: int) -> str:
    return f"{number}::UHUGEINT"


def draws(source: str, salts: dict[str, int], name: str = "draws") -> str:
    """CTEs from ``source`` (a table with ``id``) to ``<name>`` (id, draw, bits, u), a row per named salt.

    The salt is hashed before the id, so its hash is a constant here.
    """
    seeds = ", ".join(f"('{draw}', {_u(_hash_long(salt, 42) + _P5 + 8 & _MASK)})" for draw, salt in salts.items())
    mask = _u(_MASK)

    def rotated(value: str, bits: int) -> str:
        return f"((({value} * {_u(1 << bits)}) & {mask}) | ({value} >> {64 - bits}))"

    return f"""
{name}_seeds(draw, seed) AS (VALUES {seeds}),
{name}_1 AS (SELECT id, (id::UHUGEINT * {_u(_P2)}) & {mask} AS k FROM (SELECT DISTINCT id FROM {source})),
{name}_2 AS (SELECT id, ({rotated("k", 31)} * {_u(_P1)}) & {mask} AS k FROM {name}_1),
{name}_3 AS (SELECT id, draw, xor(seed, k) AS h FROM {name}_2 CROSS JOIN {name}_seeds),
{name}_4 AS (SELECT id, draw, ({rotated("h", 27)} * {_u(_P1)} + {_u(_P4)}) & {mask} AS h FROM {name}_3),
{name}_5 AS (SELECT id, draw, (xor(h, h >> 33) * {_u(_P2)}) & {mask} AS h FROM {name}_4),
{name}_6 AS (SELECT id, draw, (xor(h, h >> 29) * {_u(_P3)}) & {mask} AS h FROM {name}_5),
{name}_7 AS (SELECT id, draw, CAST(xor(h, h >> 32) >> 12 AS BIGINT) AS bits FROM {name}_6),
{name} AS (SELECT id, draw, bits, bits / 4503599627370496.0::DOUBLE AS u FROM {name}_7)"""


def fixed(value: str, places: int = 2) -> str:
    scale = f"{10**places}.0::DOUBLE"
    return f"((round_even(({value}) * {scale}, 0) + 0.0::DOUBLE) / {scale})"


def picked(draw: str) -> str:
    return f"max(CASE WHEN draw = '{draw}' THEN u END)"


def normal(first: str, second: str) -> str:
    return f"sqrt(ln(1 - {first}) * -2) * cos({second} * (2 * pi()))"


# Derived inputs

_OBSERVATION_SALTS = {
    "station": generate.STATION,
    "temp1": generate.TEMP,
    "temp2": generate.TEMP + 1,
    "humidity": generate.HUMIDITY,
    "wind": generate.WIND,
    "wet": generate.WET,
    "rain": generate.RAIN,
    "pressure1": generate.PRESSURE,
    "pressure2": generate.PRESSURE + 1,
}

IDS = "ids AS (SELECT event_id AS id FROM events)"

OBSERVATIONS = f"""{IDS},
{draws("ids", _OBSERVATION_SALTS, "obs")},
obs_wide AS (
  SELECT id, {", ".join(f"{picked(d)} AS {d}" for d in _OBSERVATION_SALTS)} FROM obs GROUP BY id
),
measured AS (
  SELECT id,
    CAST(floor(station * 10000) AS INTEGER) AS weather_station_id,
    TIMESTAMP '2024-01-31 00:00:00' - to_minutes(id) AS "timestamp",
    {fixed(normal("temp1", "temp2") + " * 12 + 25")} AS temp_celsius,
    {fixed("humidity * 60 + 40")} AS humidity_percent,
    {fixed("wind * 30 + 5")} AS wind_speed_kmh,
    {fixed("CASE WHEN wet > 0.8 THEN rain * 20 ELSE 0 END")} AS precipitation_mm,
    {fixed(normal("pressure1", "pressure2") + " * 10 + 1013")} AS pressure_hpa
  FROM obs_wide
),
observations AS (
  SELECT *, temp_celsius > 40 OR temp_celsius < -10 OR wind_speed_kmh > 100 OR precipitation_mm > 50
    AS is_extreme_weather
  FROM measured
),
features AS (
  SELECT *, CAST(month("timestamp") AS INTEGER) AS month, CAST(day("timestamp") AS INTEGER) AS day,
    CAST(hour("timestamp") AS INTEGER) AS hour
  FROM observations
)"""

_REGIME_SALTS = {
    f"{weather}.{attribute}": generate.REGIME_SALT + 10 * number + i
    for number, weather in enumerate(REGIMES)
    for i, attribute in enumerate(ATTRIBUTES)
}
_PROFILE_ROWS = ", ".join(
    f"({number}, '{weather}', '{attribute}', {float(lo)}::DOUBLE, {float(hi)}::DOUBLE)"
    for number, (weather, profile) in enumerate(REGIMES.items())
    for attribute, (lo, hi) in zip(ATTRIBUTES, profile)
)
REGIME_ROWS = f"""{IDS},
profiles(regime_no, weather, attribute, lo, hi) AS (VALUES {_PROFILE_ROWS}),
{draws("ids", _REGIME_SALTS, "reg")},
regime_values AS (
  SELECT id, regime_no, weather, attribute, {fixed("lo + u * (hi - lo)")} AS v
  FROM reg JOIN profiles ON draw = weather || '.' || attribute
),
regimes AS (
  SELECT regime_no * (SELECT count(*) FROM events) + id AS row_no,
    {", ".join(f"max(CASE WHEN attribute = '{a}' THEN v END) AS {a}" for a in ATTRIBUTES)}, weather, regime_no
  FROM regime_values GROUP BY regime_no, weather, id
)"""


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


_CITY_ROWS = ", ".join(
    f"({_text(city)}, {lat}::DOUBLE, {lon}::DOUBLE, {_text(zone)}, {_text(label)}, {_text(iso)})"
    for city, lat, lon, zone, label, iso in CITIES
)
_CITY_OF_USER = (
    "CASE user_id % 7 "
    + " ".join(f"WHEN {i} THEN '{city[0]}'" for i, city in enumerate(CITIES))
    + " ELSE 'Atlantis' END"
)
CITY_ROWS = f"cities(city, lat, lon, timezone, label, iso3) AS (VALUES {_CITY_ROWS})"

REQUESTS = f"""{CITY_ROWS},
asked AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 50 = 0 THEN 'garbage' WHEN event_id % 51 = 0 THEN '' WHEN event_id % 53 = 0 THEN NULL
      WHEN event_id % 47 = 0 THEN strftime(ts, '%m/%d/%Y %H:%M') ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS date,
    {_CITY_OF_USER} AS city
  FROM events
),
requests AS (SELECT * FROM asked WHERE date IS NULL OR date <> ''),
checked AS (
  SELECT id, date, r.city, lat, lon, timezone, label,
    COALESCE(TRY_CAST(date AS TIMESTAMP),
      TRY_CAST(regexp_replace(date, '^(\\d\\d)/(\\d\\d)/(\\d\\d\\d\\d)', '\\3-\\1-\\2') AS TIMESTAMP)) AS requested_at
  FROM requests r LEFT JOIN cities c ON r.city = c.city
),
judged AS (
  SELECT *, CASE WHEN requested_at IS NULL THEN 'Invalid date format' WHEN lat IS NULL THEN 'City not mapped' END AS error
  FROM checked
),
timed AS (
  SELECT id, city, lat, label, error,
    CASE WHEN error IS NULL THEN requested_at END AS requested_at,
    CASE WHEN error IS NULL THEN date_trunc('hour', requested_at) END AS hour_at,
    CASE WHEN error IS NULL THEN strftime(requested_at, '%Y-%m-%dT%H:00') END AS hour_key
  FROM judged
)"""

_VALUE_SALTS = {
    f"{name}{copy}": salt + 10 * copy
    for copy in (0, 1)
    for name, salt in (("t", 41), ("h", 42), ("w", 43), ("p", 44))
}

HOURS = f"""
truth_cells AS (
  SELECT {_CITY_OF_USER} AS city, date_trunc('hour', ts) AS hour_at, min(event_id) AS id
  FROM events GROUP BY ALL
),
dated AS (
  SELECT *, CAST(DATE '2024-01-01' + CAST(floor((hour_at::DATE - DATE '2024-01-01') / 7) AS INTEGER) * 7 AS DATE) AS issued
  FROM truth_cells WHERE city NOT IN ('Mumbai', 'Atlantis')
),
copies AS (
  SELECT *, 0 AS copy FROM dated
  UNION ALL
  SELECT *, 1 AS copy FROM dated WHERE hour(hour_at) = 2 AND hour_at::DATE = issued
),
{draws("dated", _VALUE_SALTS, "val")},
val_wide AS (SELECT id, {", ".join(f"{picked(d)} AS {d}" for d in _VALUE_SALTS)} FROM val GROUP BY id),
hours AS (
  SELECT city, CASE WHEN city <> 'Sydney' THEN issued END AS issued,
    CAST(row_number() OVER (PARTITION BY city, issued ORDER BY hour_at, copy) - 1 AS INTEGER) AS pos,
    hour_at, strftime(hour_at, '%Y-%m-%dT%H:00') AS "time",
    CASE WHEN id % 13 <> 0 THEN {fixed("(CASE copy WHEN 0 THEN t0 ELSE t1 END) * 30", 1)} END AS temperature_2m,
    floor((CASE copy WHEN 0 THEN h0 ELSE h1 END) * 60 + 40) AS relative_humidity_2m,
    {fixed("(CASE copy WHEN 0 THEN w0 ELSE w1 END) * 30", 1)} AS wind_speed_10m,
    {fixed("(CASE copy WHEN 0 THEN p0 ELSE p1 END) * 5", 1)} AS precipitation
  FROM copies JOIN val_wide USING (id)
  WHERE issued >= DATE '2024-01-08' AND NOT (city = 'London' AND issued = DATE '2024-01-15')
)"""

TRUTH_ROWS = f"""{HOURS},
truth AS (
  SELECT city, hour_at, temperature_2m AS real_temp_celsius, relative_humidity_2m AS real_humidity_percent,
    wind_speed_10m AS real_wind_speed_kmh, precipitation AS real_precipitation_mm, TRUE AS hit
  FROM hours QUALIFY row_number() OVER (PARTITION BY city, hour_at ORDER BY issued DESC, pos) = 1
)"""

TRUTH = f"""{TRUTH_ROWS},
looked_up AS (
  SELECT t.*, COALESCE(hit, FALSE) AS real_found, real_temp_celsius, real_humidity_percent, real_wind_speed_kmh,
    real_precipitation_mm
  FROM timed t LEFT JOIN truth g ON t.city = g.city AND t.hour_at = g.hour_at
)"""

SEASON = """CASE (CASE WHEN lat >= 0 THEN {month} % 12 ELSE ({month} + 6) % 12 END) // 3
  WHEN 0 THEN 'winter' WHEN 1 THEN 'spring' WHEN 2 THEN 'summer' WHEN 3 THEN 'autumn' END"""

_AI = [f"ai_{t}" for t in (*TARGETS, "is_extreme_weather")]

_STEPS = {
    "temp_celsius": "(CASE WHEN hour({at}) < 16 THEN 12 ELSE 27 END)::DOUBLE",
    "humidity_percent": "(CASE WHEN hour({at}) < 10 THEN 80 ELSE 55 END)::DOUBLE",
    "wind_speed_kmh": "(CASE WHEN hour({at}) < 14 THEN 10 ELSE 20 END)::DOUBLE",
    "precipitation_mm": "(CASE WHEN hour({at}) < 20 THEN 0 ELSE 4 END)::DOUBLE",
    "is_extreme_weather": "hour({at}) >= 12",
}


def _verified(values: dict[str, str]) -> str:
    """Every request judged, given SQL for the predictions of an accepted one."""
    return f"""{OBSERVATIONS},
{REQUESTS},
{TRUTH},
predicted AS (
  SELECT l.* REPLACE (CASE WHEN error IS NULL THEN real_found END AS real_found),
    {", ".join(f"CASE WHEN error IS NULL THEN {v} END AS ai_{t}" for t, v in values.items())}
  FROM looked_up l JOIN observations o USING (id)
),
deviated AS (
  SELECT *, round(abs(ai_temp_celsius::DECIMAL(18,2) - real_temp_celsius::DECIMAL(18,2)), 1)::DECIMAL(18,1) AS gap
  FROM predicted
),
verified AS (
  SELECT id, city, label, requested_at, hour_key,
    {SEASON.format(month="month(requested_at)")} AS season, error, {", ".join(_AI)}, real_found,
    {", ".join(f"real_{t}" for t in TARGETS)},
    gap::DOUBLE AS deviation,
    CASE WHEN NOT real_found THEN 'API 7-day query limit exceeded.'
      WHEN gap < 5 THEN 'Deviation: ' || gap || '°C. Excellent Synthetic Match!'
      WHEN gap < 12 THEN 'Deviation: ' || gap || '°C. Acceptable variance.'
      WHEN gap >= 12 THEN 'Deviation: ' || gap || '°C. AI deviates heavily from live API.' END AS verdict,
    CASE WHEN ai_is_extreme_weather THEN 'ALERT ACTIVE' WHEN NOT ai_is_extreme_weather THEN 'ALL CLEAR' END AS alert
  FROM deviated
)"""


VERIFIED = _verified({t: f"o.{t}" for t in (*TARGETS, "is_extreme_weather")})
STEPPED = {t: v.format(at="requested_at") for t, v in _STEPS.items()}


def _number(value: str) -> str:
    return f"regexp_replace(CAST({value} AS VARCHAR), '\\.0$', '')"


# Sources and dimensions

ORACLES["id_range"] = "SELECT CAST(range AS BIGINT) AS id FROM range((SELECT count(*) FROM events))"
ORACLES["city_dim"] = f"""
WITH {REQUESTS}
SELECT c.*, trunc(lat * 10) / 10 AS lat_shown, trunc(lon * 10) / 10 AS lon_shown,
  (SELECT count(*) FROM asked a WHERE a.city = c.city) AS n_requests
FROM cities c"""
ORACLES["regime_dim"] = f"""
WITH {REGIME_ROWS}
SELECT CAST(r.regime_no AS INTEGER) AS regime_no, r.weather,
  {", ".join(f"{a}_lo, {a}_hi" for a in ATTRIBUTES)},
  count(*) AS n_rows,
  count(*) FILTER ({" AND ".join(f"{a} BETWEEN {a}_lo AND {a}_hi" for a in ATTRIBUTES)}) AS n_inside
FROM regimes r JOIN (
  SELECT weather, {", ".join(f"max(CASE WHEN attribute = '{a}' THEN lo END) AS {a}_lo, max(CASE WHEN attribute = '{a}' THEN hi END) AS {a}_hi" for a in ATTRIBUTES)}
  FROM profiles GROUP BY weather
) p ON r.weather = p.weather
GROUP BY ALL"""

# Generation and projection

ORACLES["gen_observations"] = f"WITH {OBSERVATIONS} SELECT * FROM measured"
ORACLES["gen_regimes"] = f"WITH {REGIME_ROWS} SELECT {', '.join(ATTRIBUTES)}, weather FROM regimes"
ORACLES["union_regimes"] = f"WITH {REGIME_ROWS} SELECT row_no, {', '.join(ATTRIBUTES)}, weather FROM regimes"
ORACLES["label_extreme"] = f"WITH {OBSERVATIONS} SELECT id, temp_celsius, is_extreme_weather FROM observations"
ORACLES["calendar_features"] = f"""WITH {OBSERVATIONS} SELECT id, "timestamp", month, day, hour FROM features"""
ORACLES["feature_matrix"] = f"""
WITH {OBSERVATIONS}
SELECT id, month::DOUBLE AS feature_month, day::DOUBLE AS feature_day, hour::DOUBLE AS feature_hour,
  CAST(is_extreme_weather AS INTEGER) AS extreme, {", ".join(TARGETS)}
FROM features"""
ORACLES["rename_units"] = f"""
WITH {REGIME_ROWS}
SELECT {", ".join(f'{a} AS "{a} ({UNITS[a]})"' for a in ATTRIBUTES)}, weather FROM regimes"""

# Requests

ORACLES["parse_requests"] = f"WITH {REQUESTS} SELECT id, date, city FROM requests"
ORACLES["default_requests"] = f"""
WITH {REQUESTS}
SELECT id,
  CASE WHEN date IS NULL OR date IN ('garbage', '') THEN '2024-01-31T17:00' ELSE date END AS date,
  CASE WHEN city = 'Atlantis' THEN 'Dhaka' ELSE city END AS city
FROM asked"""
ORACLES["validate_requests"] = f"WITH {REQUESTS} SELECT id, date, city, requested_at, error FROM judged"
ORACLES["city_lookup"] = f"WITH {REQUESTS} SELECT id, city, lat, lon, timezone, label FROM checked"
ORACLES["hour_key"] = """
SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:00') AS hour_key, date_trunc('hour', ts) AS hour_at FROM events"""

# Ground truth

ORACLES["ground_truth_hours"] = f"""
WITH {HOURS}
SELECT city, issued, pos, "time", temperature_2m, relative_humidity_2m, wind_speed_10m, precipitation FROM hours"""
ORACLES["ground_truth_lookup"] = f"""
WITH {REQUESTS},
{TRUTH}
SELECT id, city, hour_key, real_found, {", ".join(f"real_{t}" for t in TARGETS)} FROM looked_up WHERE error IS NULL"""
ORACLES["ground_truth_lookup_shuffled"] = ORACLES["ground_truth_lookup"]

ORACLES["ground_truth_lookup_bucketed"] = ORACLES["ground_truth_lookup"]
ORACLES["ground_truth_merged"] = f"WITH {TRUTH_ROWS} SELECT * EXCLUDE (hit) FROM truth"

# Verdicts

ORACLES["season"] = f"""
WITH {OBSERVATIONS},
{CITY_ROWS},
placed AS (
  SELECT id, CAST((month + id) % 12 + 1 AS INTEGER) AS month,
    ['New York', 'London', 'Tokyo', 'Sydney', 'Mumbai', 'Dhaka'][id % 6 + 1] AS city
  FROM features
)
SELECT id, p.city, month, {SEASON.format(month="month")} AS season FROM placed p JOIN cities c ON p.city = c.city"""
ORACLES["deviation_verdict"] = f"""
WITH {VERIFIED}
SELECT id, ai_temp_celsius, real_temp_celsius, deviation, verdict FROM verified WHERE error IS NULL"""
ORACLES["alert_status"] = f"""
WITH {OBSERVATIONS}
SELECT id, CASE WHEN is_extreme_weather THEN 'ALERT ACTIVE' ELSE 'ALL CLEAR' END AS alert FROM observations"""
ORACLES["display_fields"] = f"""
WITH {VERIFIED}
SELECT id, label AS location, strftime(requested_at, '%A, %I:%M %p') AS moment,
  {_number("ai_temp_celsius")} || '°C' AS ai_temp,
  {_number("ai_precipitation_mm")} || ' mm' AS ai_precip,
  {_number("ai_humidity_percent")} || '%' AS ai_humid,
  {_number("ai_temp_celsius")} || '°' AS synth_temp,
  {_number("ai_wind_speed_kmh")} || ' km/h' AS synth_wind,
  COALESCE({_number("real_temp_celsius")} || '°', 'N/A') AS real_temp,
  COALESCE({_number("real_wind_speed_kmh")} || ' km/h', '--') AS real_wind,
  verdict AS report, alert AS status
FROM verified WHERE error IS NULL"""


def _json_fields(prefix: str, fields: tuple[str, ...]) -> str:
    return " || ',' || ".join(
        f"""'"{f}":' || COALESCE(CAST({prefix}_{f} AS VARCHAR), 'null')""" for f in fields
    )


ORACLES["result_json"] = f"""
WITH {VERIFIED}
SELECT id, CASE
  WHEN error IS NOT NULL THEN '{{"error":"' || error || '"}}'
  ELSE '{{"ai":{{' || {_json_fields("ai", (*TARGETS, "is_extreme_weather"))} || '}},"real":{{'
    || CASE WHEN real_found THEN {_json_fields("real", ("found", *TARGETS))} ELSE '"found":false' END || '}}}}'
  END AS response
FROM verified"""
ORACLES["verify_rules"] = f"WITH {VERIFIED} SELECT * FROM verified"
ORACLES["verify_rules_stream"] = ORACLES["verify_rules"]
ORACLES["verify_rules_refreshed"] = ORACLES["verify_rules"]
ORACLES["verify_rules_awaited"] = ORACLES["verify_rules"]
ORACLES["requests_quarantine"] = """
WITH lines AS (SELECT event_id AS id, '{"event_id":' || event_id || ',"date":"' AS front, event_id % 11 AS kind FROM events)
SELECT CASE kind WHEN 0 THEN substr(front, 1, 12) WHEN 1 THEN '[' || id || ']' WHEN 2 THEN CAST(id AS VARCHAR) ELSE '' END AS body,
  CASE kind WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no JSON object but array' WHEN 2 THEN 'no JSON object but bigint' ELSE 'empty line' END AS reason
FROM lines WHERE kind < 4
UNION ALL SELECT NULL, count(*) || ' sound' FROM lines WHERE kind >= 4"""
ORACLES["observations_quarantine"] = """
SELECT CAST(event_id AS VARCHAR) AS record,
  CASE event_id % 13 WHEN 0 THEN '7 of 9 fields' WHEN 1 THEN '10 of 9 fields' WHEN 2 THEN 'temp_celsius is no double: warm'
    WHEN 3 THEN 'temp_celsius is missing' ELSE 'sound' END AS reason
FROM events"""

# Aggregates and metrics

ORACLES["row_counts"] = f"""
WITH {REGIME_ROWS}
SELECT weather, count(*) AS n_rows FROM regimes GROUP BY weather
UNION ALL SELECT 'All Data', count(*) FROM regimes"""

_CLASSIFICATION = """
SELECT 'extreme' AS model, 'accuracy' AS metric, round(avg(CAST(quality = toxic AS INTEGER)), 9) AS value FROM labels
UNION ALL
SELECT 'extreme', 'precision',
  COALESCE(round(count(*) FILTER (toxic = 1 AND quality = 1) / nullif(count(*) FILTER (toxic = 1), 0), 9), 0)
FROM labels"""
_REGRESSION = " UNION ALL ".join(
    f"""
SELECT '{t}' AS model, 'mae' AS metric, round(avg(abs({t} - (hour * 0.25::DOUBLE + {10 * i}))), 6) AS value FROM features"""
    for i, t in enumerate(TARGETS, 1)
)
ORACLES["classification_metrics"] = _CLASSIFICATION
ORACLES["regression_metrics"] = f"WITH {OBSERVATIONS} {_REGRESSION}"
ORACLES["metric_display"] = f"""
WITH {OBSERVATIONS},
scores AS ({_CLASSIFICATION} UNION ALL {_REGRESSION})
SELECT model, metric, value,
  CASE WHEN metric <> 'mae' THEN printf('%.1f%%', value * 100)
    WHEN model = 'temp_celsius' THEN printf('%.2f°C', value)
    WHEN model = 'humidity_percent' THEN printf('%.2f%%', value) END AS headline,
  CASE WHEN metric = 'mae' AND model <> 'humidity_percent' THEN printf('%.4f', value) END AS detail
FROM scores"""

# Samples and splits


def _drawn(salt: int) -> str:
    return draws("ids", {"d": salt}, "pick")


ORACLES["sample_exact"] = f"""
WITH {OBSERVATIONS},
{_drawn(101)}
SELECT id, temp_celsius FROM observations WHERE id IN (
  SELECT id FROM pick ORDER BY bits, id LIMIT (SELECT count(*) // 3 FROM events))"""
ORACLES["sample_capped"] = f"""
WITH {OBSERVATIONS},
{_drawn(101)}
SELECT id, temp_celsius FROM observations WHERE id IN (SELECT id FROM pick ORDER BY bits, id LIMIT 10000)"""
ORACLES["split_bucket"] = f"WITH {IDS}, {_drawn(102)} SELECT id, u < 0.2 AS is_test FROM pick"
ORACLES["split_exact"] = f"""
WITH {IDS}, {_drawn(102)}
SELECT id, row_number() OVER (ORDER BY bits, id) <= ceil((SELECT count(*) FROM events) * 0.2::DOUBLE) AS is_test FROM pick"""
ORACLES["head_rows"] = f"WITH {OBSERVATIONS} SELECT * FROM observations ORDER BY id LIMIT 5"

# Sinks

ORACLES["csv_roundtrip"] = f"WITH {OBSERVATIONS} SELECT * FROM observations"
ORACLES["parquet_roundtrip"] = ORACLES["csv_roundtrip"]
ORACLES["table_roundtrip"] = ORACLES["csv_roundtrip"]
ORACLES["regime_fanout"] = f"""
WITH {REGIME_ROWS}
SELECT weather AS sheet, count(*) AS n_rows FROM regimes GROUP BY weather
UNION ALL SELECT 'All Data', count(*) FROM regimes"""
ORACLES["regime_fanout_csv"] = f"""
WITH {REGIME_ROWS}
SELECT row_no, {", ".join(f'{a} AS "{a} ({UNITS[a]})"' for a in ATTRIBUTES)}, weather FROM regimes"""

# Models

ORACLES["training_cells"] = f"""
WITH {OBSERVATIONS},
{draws("ids", {"replicate": 103}, "rep")}
SELECT month, day, hour, CAST(bits % 32 AS INTEGER) AS replicate, CAST(is_extreme_weather AS INTEGER) AS extreme,
  count(*) AS weight,
  {", ".join(f"CAST(sum(CAST(round({t} * 100) AS BIGINT)) AS BIGINT) AS {t}_hundredths" for t in TARGETS)}
FROM features f JOIN rep ON f.id = rep.id GROUP BY ALL"""
_CELL_SUMS = ", ".join(f"CAST(sum({{times}}CAST(round({t} * 100) AS BIGINT)) AS BIGINT) AS {t}_hundredths" for t in TARGETS)
ORACLES["training_cells_merged"] = f"""
WITH {OBSERVATIONS},
{draws("ids", {"replicate": 103}, "rep")},
{_drawn(102)}
SELECT month, day, hour, CAST(rep.bits % 32 AS INTEGER) AS replicate, CAST(is_extreme_weather AS INTEGER) AS extreme,
  CAST(count(*) AS BIGINT) AS weight, {_CELL_SUMS.format(times="")}
FROM features f JOIN rep ON f.id = rep.id JOIN pick ON f.id = pick.id WHERE pick.u >= 0.2::DOUBLE GROUP BY ALL"""
_TREES = {str(t): train.BOOTSTRAP_SALT + t for t in range(train.CLASSIFIER_TREES)}
_TIMES = " + ".join(f"CAST(u >= {p!r}::DOUBLE AS BIGINT)" for p in train.AT_MOST)
ORACLES["bootstrap_cells"] = f"""
WITH {OBSERVATIONS},
{draws("ids", _TREES, "boot")},
times AS (SELECT id, CAST(draw AS INTEGER) AS tree, {_TIMES} AS times FROM boot)
SELECT tree, month, day, hour, CAST(is_extreme_weather AS INTEGER) AS extreme, CAST(sum(times) AS BIGINT) AS weight,
  {_CELL_SUMS.format(times="times * ")}
FROM features JOIN times USING (id) WHERE times > 0 GROUP BY ALL"""
ORACLES["timeline_hours"] = f"""
WITH {REQUESTS},
starts AS (SELECT city, max(hour_at) AS start_at FROM timed WHERE error IS NULL GROUP BY city),
ahead AS (SELECT city, start_at + to_hours(CAST(h.range AS BIGINT)) AS hour_at FROM starts CROSS JOIN range(168) h)
SELECT city, hour_at, CAST(month(hour_at) AS INTEGER) AS month, CAST(day(hour_at) AS INTEGER) AS day,
  CAST(hour(hour_at) AS INTEGER) AS hour
FROM ahead"""


def _over(at: str, prefix: str) -> str:
    return ", ".join(f"{v.format(at=at)} AS {prefix}{t}" for t, v in _STEPS.items())


_HELD_OUT = f"""
WITH {OBSERVATIONS}, {_drawn(102)},
held_out AS (
  SELECT id, {_over('"timestamp"', "step_")} FROM features JOIN (SELECT id FROM pick WHERE u < 0.2::DOUBLE) USING (id)
)"""
ORACLES["forest_classify"] = f"""{_HELD_OUT}
SELECT id, CAST(step_is_extreme_weather AS INTEGER) AS extreme, CAST(step_is_extreme_weather AS INTEGER)::DOUBLE AS predicted_extreme
FROM held_out"""
ORACLES["forest_regress"] = f"""{_HELD_OUT}
SELECT id, {", ".join(f"step_{t} AS {t}, step_{t} AS predicted_{t}" for t in TARGETS)} FROM held_out"""
ORACLES["train_metrics"] = f"""{_HELD_OUT}
SELECT 'extreme' AS model, 'accuracy' AS metric, 1::DOUBLE AS value
UNION ALL SELECT 'extreme', 'precision', CAST(max(CAST(step_is_extreme_weather AS INTEGER)) AS DOUBLE) FROM held_out
{" ".join(f"UNION ALL SELECT '{t}', 'mae', 0::DOUBLE" for t in TARGETS)}"""
ORACLES["score_requests"] = f"""
WITH {REQUESTS}
SELECT id, city, hour_key, {_over("requested_at", "ai_")} FROM timed WHERE error IS NULL"""
ORACLES["verify_batch"] = f"WITH {_verified(STEPPED)} SELECT * FROM verified"
ORACLES["verify_stream"] = ORACLES["verify_batch"]
ORACLES["forecast_timeline"] = ORACLES["timeline_hours"].replace(
    "\nFROM ahead", f",\n  {_over('hour_at', 'ai_')}\nFROM ahead"
)
