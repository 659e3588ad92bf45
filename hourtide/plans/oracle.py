"""Independent SQL for the registered queries, in the dialect of the checking database.

Each text states its result over whole tables, from the same derived observations.
"""

from __future__ import annotations

from hourtide import fixed_values as fv
from hourtide.sources.observations import COPY_EVERY, OBSERVATIONS_FROM_ORDERS

ORACLE: dict[str, str] = {}

FIRST_YEAR, LAST_YEAR, TRAIN_THROUGH, TEST_YEAR, PRODUCTION_YEAR = 1995, 2001, 1999, 2000, 2001


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(column: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else str(v)) for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


SEVERITY = _case("weather_main", fv.WEATHER_SEVERITY, "2")
GROUP = _case("weather_main", fv.WEATHER_GROUPS, "'Other'")
BUCKET = _case("lower(weather_main)", {w: b for b, ws in fv.WEATHER_BUCKETS.items() for w in ws}, "'other'")
DAY_PART = (
    "CASE WHEN hour BETWEEN 6 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 16 THEN 'afternoon' "
    "WHEN hour BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END"
)
DAY_TYPE = "CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END"

_base = OBSERVATIONS_FROM_ORDERS.format(orders="orders")
_means = ", ".join(f"avg({c}) AS {c}" for c in ("temp", "rain_1h", "snow_1h", "clouds_all"))
_bare = "trim(weather_main, chr(9) || ' ')"
_title = f"upper(left({_bare}, 1)) || lower(substr({_bare}, 2))"


def _standard(source: str) -> str:
    return (
        "SELECT seq, coalesce(holiday, 'No Holiday') AS holiday, temp, rain_1h, snow_1h, clouds_all, "
        f"{_title} AS weather_main, lower(trim(weather_description)) AS weather_description, date_time, traffic_volume FROM {source}"
    )


def _distinct(source: str) -> str:
    return f"SELECT {', '.join(fv.RAW_COLUMNS)}, min(seq) AS seq FROM {source} GROUP BY {', '.join(fv.RAW_COLUMNS)}"


def _per_timestamp(source: str) -> str:
    return f"""
SELECT r.date_time, r.holiday, r.temp, r.rain_1h, r.snow_1h, r.clouds_all, r.weather_main, t.weather_description,
 r.traffic_volume, r.n_weather_conditions
FROM (SELECT date_time, arg_min(holiday, seq) AS holiday, {_means},
  first(weather_main ORDER BY {SEVERITY} DESC, seq) AS weather_main,
  arg_min(traffic_volume, seq) AS traffic_volume, count(*) AS n_weather_conditions FROM {source} GROUP BY date_time) r
JOIN (SELECT date_time, string_agg(weather_description, '; ' ORDER BY s) AS weather_description
  FROM (SELECT date_time, weather_description, min(seq) AS s FROM {source} GROUP BY ALL) GROUP BY date_time) t
ON r.date_time = t.date_time"""


def _outliers_imputed(source: str) -> str:
    return f"""
SELECT h.* REPLACE (CASE WHEN h.temp = 0 THEN m.t ELSE h.temp END AS temp,
 CASE WHEN h.rain_1h > 9000 THEN m.r ELSE h.rain_1h END AS rain_1h)
FROM {source} h JOIN (SELECT month(date_time) AS mon, median(temp) FILTER (temp <> 0) AS t,
  median(rain_1h) FILTER (rain_1h <= 9000) AS r FROM {source} GROUP BY 1) m ON month(h.date_time) = m.mon"""


_filled = ", ".join(f"coalesce(CAST(o.{c} AS DOUBLE), m.{c}) AS {c}" for c in fv.NUMERIC_COLUMNS)
_one_hot = ", ".join(f"CAST(weather_main = '{c}' AS INT) AS \"weather_{c}\"" for c in fv.WEATHER_CATEGORIES)
_norms = ", ".join(
    f"({c} - (SELECT min({c}) FROM cleaned)) / nullif((SELECT max({c}) - min({c}) FROM cleaned), 0) AS {c}_norm"
    for c in fv.SCALED_COLUMNS
)
_CATEGORY = (
    "CASE WHEN traffic_volume <= q.q1 THEN 'Low' WHEN traffic_volume <= q.q2 THEN 'Medium' "
    "WHEN traffic_volume <= q.q3 THEN 'High' WHEN traffic_volume > q.q3 THEN 'Severe' ELSE 'Medium' END"
)
_quartiles = (
    "SELECT quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2, "
    "quantile_cont(traffic_volume, 0.75) AS q3 FROM cleaned"
)

# Named steps; a query takes every step up to the one it needs.
STEPS: list[tuple[str, str]] = [
    ("base", _base),
    ("obs", f"SELECT * FROM base UNION ALL SELECT * FROM base WHERE seq % {COPY_EVERY} = 0"),
    ("raw_std", _standard("obs")),
    ("raw_distinct", _distinct("raw_std")),
    ("hourly", _per_timestamp("raw_distinct")),
    (
        "medians",
        "SELECT month(date_time) AS mon, " + ", ".join(f"median({c}) AS {c}" for c in fv.NUMERIC_COLUMNS) + " FROM obs GROUP BY 1",
    ),
    (
        "filled",
        f"SELECT o.seq, o.holiday, o.weather_main, o.weather_description, o.date_time, {_filled} "
        "FROM obs o JOIN medians m ON month(o.date_time) = m.mon",
    ),
    ("std", _standard("filled")),
    ("distinct_rows", _distinct("std")),
    ("filled_hourly", _per_timestamp("distinct_rows")),
    ("cleaned", _outliers_imputed("filled_hourly")),
    (
        "timed",
        "SELECT *, CAST(hour(date_time) AS INT) AS hour, CAST(isodow(date_time) - 1 AS INT) AS day_of_week, "
        "CAST(isodow(date_time) >= 6 AS INT) AS is_weekend FROM cleaned",
    ),
    (
        "featured",
        "SELECT t.*, sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos, "
        "sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos, "
        "CAST(CAST(date_time AS DATE) IN (SELECT CAST(date_time AS DATE) FROM cleaned WHERE holiday <> 'No Holiday') AS INT) AS is_holiday, "
        f"{_one_hot}, CAST(weather_main IN ({_names(fv.RAINY_WEATHER)}) AS INT) AS is_rainy, "
        "CAST(weather_main = 'Snow' AS INT) AS is_snowy, "
        f"CAST(clouds_all > 80 AND weather_main IN ({_names(fv.LOW_VISIBILITY_WEATHER)}) AS INT) AS is_low_visibility, "
        f"{SEVERITY} AS weather_severity, {_norms}, {_CATEGORY} AS congestion_category FROM timed t, ({_quartiles}) q",
    ),
    (
        "labelled",
        f"SELECT *, {DAY_TYPE} AS day_type, {GROUP} AS weather_category, "
        f"CAST(congestion_category IN ({_names(fv.RISKY_CONGESTION)}) AND (weather_main IN ({_names(fv.RISKY_WEATHER)}) "
        "OR is_low_visibility = 1) AS INT) AS high_risk, "
        f"CASE WHEN year(date_time) <= {TRAIN_THROUGH} THEN 'train' WHEN year(date_time) = {TEST_YEAR} THEN 'test' "
        f"WHEN year(date_time) = {PRODUCTION_YEAR} THEN 'production' END AS split FROM featured",
    ),
]


#: Steps that a query reads several times and that are too long a chain to be computed each time.
READ_OFTEN = ("cells", "points")


def _with(upto: str, sql: str, *more: tuple[str, str]) -> str:
    taken = []
    for name, text in STEPS:
        taken.append(f"{name} AS ({text})")
        if name == upto:
            break
    taken += [f"{name} AS {'MATERIALIZED ' if name in READ_OFTEN else ''}({text})" for name, text in more]
    return "WITH " + ",\n".join(taken) + "\n" + sql


def _round(sql: str, columns: str, digits: int = 6) -> str:
    """Round the named double columns; adding zero turns a negative zero into zero."""
    rounds = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({rounds}) FROM ({sql})"


def add(key: str, upto: str | None, sql: str, rounds: str = "", digits: int = 6, more: tuple = ()) -> None:
    body = _round(sql, rounds, digits) if rounds else sql
    ORACLE[key] = _with(upto, body, *more) if upto else body


# --- scans and profiles
add("scan_typed", "obs", "SELECT count(*) AS n_rows, " + ", ".join(f"count({c}) AS {c}_n" for c in fv.RAW_COLUMNS) + " FROM obs")
add(
    "validate_schema",
    "obs",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS present, count({c}) AS n_values FROM obs" for c in fv.RAW_COLUMNS)
    + " UNION ALL SELECT 'visibility', false, 0",
)
_types = {
    "seq": "bigint",
    "holiday": "string",
    "temp": "double",
    "rain_1h": "double",
    "snow_1h": "double",
    "clouds_all": "int",
    "weather_main": "string",
    "weather_description": "string",
    "date_time": "timestamp_ntz",
    "traffic_volume": "int",
}
add(
    "column_info",
    "obs",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS position, '{c}' AS name, '{t}' AS type, count({c}) AS n_values FROM obs"
        for i, (c, t) in enumerate(_types.items())
    ),
)
add("sample_rows", "obs", "SELECT * FROM obs ORDER BY seq LIMIT 5")
add("sample_n", "obs", "SELECT seq, date_time, temp, traffic_volume FROM obs ORDER BY md5('42|' || seq), seq LIMIT 5000")
add("row_count", "obs", "SELECT count(*) AS total_rows FROM obs")
add("unique_timestamps", "obs", "SELECT count(DISTINCT date_time) AS unique_timestamps FROM obs")
add(
    "null_blank_counts",
    "obs",
    "SELECT count(*) FILTER (holiday IS NULL OR holiday = '') AS holiday_nulls, count(*) FILTER (temp IS NULL) AS temp_nulls, "
    "count(*) FILTER (rain_1h IS NULL) AS rain_nulls, count(*) FILTER (snow_1h IS NULL) AS snow_nulls, "
    "count(*) FILTER (clouds_all IS NULL) AS clouds_nulls, count(*) FILTER (weather_main IS NULL OR weather_main = '') AS weather_main_nulls, "
    "count(*) FILTER (date_time IS NULL) AS date_time_nulls, count(*) FILTER (traffic_volume IS NULL) AS traffic_volume_nulls FROM obs",
)
add(
    "null_profile",
    "obs",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count({c}) AS named_count FROM obs"
        for c in fv.RAW_COLUMNS
    ),
)
add(
    "standardise_text",
    "obs",
    f"SELECT 'weather_main' AS column_name, count(*) FILTER (weather_main IS DISTINCT FROM {_title}) AS changed FROM obs UNION ALL "
    "SELECT 'weather_description', count(*) FILTER (weather_description IS DISTINCT FROM lower(trim(weather_description))) FROM obs UNION ALL "
    "SELECT 'holiday', count(*) FILTER (holiday IS NULL) FROM obs",
)
add("parse_timestamps", "obs", "SELECT seq, strptime(strftime(date_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS date_time FROM obs")
add(
    "day_lookup",
    "featured",
    "SELECT date_time, hour, traffic_volume, weather_main, temp FROM featured WHERE CAST(date_time AS DATE) = DATE '1997-06-15' ORDER BY date_time",
    "temp",
)
add("filter_year_range", "cleaned", "SELECT date_time, temp, traffic_volume FROM cleaned WHERE year(date_time) BETWEEN 1997 AND 1999")
add(
    "filter_membership",
    "cleaned",
    "SELECT date_time, holiday, weather_main FROM cleaned WHERE holiday IN ('New Years Day', 'Labor Day') "
    "OR weather_main IN ('Rain', 'Drizzle', 'Thunderstorm')",
)
add(
    "volume_band",
    "obs",
    "SELECT CASE WHEN traffic_volume > 5500 THEN 'High' WHEN traffic_volume > 4500 THEN 'Medium' WHEN traffic_volume > -1 THEN 'Low' END AS volume_band, "
    "count(*) AS n, min(traffic_volume) AS low, max(traffic_volume) AS high FROM obs GROUP BY 1",
)
add("kelvin_to_celsius", "obs", "SELECT seq, temp, temp - CAST(273.15 AS DOUBLE) AS temp_celsius FROM obs", "temp temp_celsius")
add("distinct_categories", "cleaned", "SELECT DISTINCT weather_main FROM cleaned ORDER BY 1")

# --- cleaning
add("exact_dedupe", "raw_distinct", "SELECT * FROM raw_distinct")
add(
    "repeat_profile",
    "raw_distinct",
    "SELECT count(*) FILTER (n > 1) AS repeated_timestamps, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows, "
    "count(*) FILTER (v > 1) AS inconsistent_timestamps FROM (SELECT date_time, count(*) AS n, count(DISTINCT traffic_volume) AS v "
    "FROM raw_distinct GROUP BY 1)",
)
add("timestamp_aggregate", "hourly", "SELECT * FROM hourly", "temp rain_1h snow_1h clouds_all")
add(
    "timestamp_mean_dedupe",
    "obs",
    "SELECT date_time, avg(temp) AS temp, avg(traffic_volume) AS traffic_volume FROM obs GROUP BY 1",
    "temp traffic_volume",
)
add("impute_null_monthly_median", "filled", f"SELECT seq, date_time, {', '.join(fv.NUMERIC_COLUMNS)} FROM filled")
add(
    "detect_outliers",
    "hourly",
    "SELECT count(*) AS n_rows, count(*) FILTER (temp = 0) AS temp_outliers, count(*) FILTER (rain_1h > 9000) AS rain_1h_outliers FROM hourly",
)
add(
    "impute_outlier_monthly_median",
    "hourly",
    "SELECT date_time, temp, rain_1h FROM fixed",
    "temp rain_1h",
    more=(("fixed", _outliers_imputed("hourly")),),
)
add("clean_pipeline", "cleaned", "SELECT * FROM cleaned", "temp rain_1h snow_1h clouds_all traffic_volume")
_log = [
    ("load", "rows_in", "SELECT count(*) FROM obs"),
    *[("missing_values", f"nulls_{c}", f"SELECT count(*) FROM obs WHERE {c} IS NULL") for c in fv.RAW_COLUMNS],
    ("standardise", "changed_weather_main", f"SELECT count(*) FROM obs WHERE weather_main IS DISTINCT FROM {_title}"),
    (
        "standardise",
        "changed_weather_description",
        "SELECT count(*) FROM obs WHERE weather_description IS DISTINCT FROM lower(trim(weather_description))",
    ),
    ("duplicates", "exact_duplicates", "SELECT (SELECT count(*) FROM obs) - (SELECT count(*) FROM distinct_rows)"),
    ("duplicates", "repeated_timestamps", "SELECT count(*) FROM filled_hourly WHERE n_weather_conditions > 1"),
    ("duplicates", "extra_rows", "SELECT CAST(sum(n_weather_conditions - 1) AS BIGINT) FROM filled_hourly"),
    (
        "duplicates",
        "inconsistent_timestamps",
        "SELECT count(*) FROM (SELECT date_time FROM distinct_rows GROUP BY 1 HAVING count(DISTINCT traffic_volume) > 1)",
    ),
    ("save", "rows_out", "SELECT count(*) FROM filled_hourly"),
    ("outliers", "outliers_temp", "SELECT count(*) FROM filled_hourly WHERE temp = 0"),
    ("outliers", "outliers_rain_1h", "SELECT count(*) FROM filled_hourly WHERE rain_1h > 9000"),
]
add(
    "quality_log",
    "filled_hourly",
    "SELECT step, CASE WHEN value > 0 AND metric NOT IN ('rows_in', 'rows_out', 'nulls_holiday') THEN 'WARNING' ELSE 'INFO' END AS level, "
    "metric, value FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS step, '{m}' AS metric, CAST(({q}) AS BIGINT) AS value" for s, m, q in _log)
    + ")",
)
add("holiday_flag", "featured", "SELECT date_time, holiday, is_holiday FROM featured")
add("severity_lookup", "cleaned", f"SELECT weather_main, CAST({SEVERITY} AS INT) AS weather_severity, count(*) AS n FROM cleaned GROUP BY 1, 2")
add("weather_category", "cleaned", f"SELECT weather_main, {GROUP} AS weather_category, count(*) AS n FROM cleaned GROUP BY 1, 2")
add("weather_bucket", "cleaned", f"SELECT weather_main, {BUCKET} AS weather_bucket, count(*) AS n FROM cleaned GROUP BY 1, 2")

# --- trends
_annual = (
    "annual",
    "SELECT CAST(year(date_time) AS INT) AS year, count(*) AS hours_of_data, avg(v) AS avg_volume, "
    "CAST(trunc(sum(v)) AS BIGINT) AS total_volume, min(date_time) AS first_record, max(date_time) AS last_record "
    "FROM (SELECT date_time, avg(traffic_volume) AS v FROM obs GROUP BY 1) "
    f"WHERE year(date_time) BETWEEN {FIRST_YEAR} AND {LAST_YEAR} GROUP BY 1",
)
add(
    "annual_trend",
    "obs",
    "SELECT year, hours_of_data, avg_volume AS avg_volume_per_hour, total_volume, first_record, last_record FROM annual",
    "avg_volume_per_hour",
    more=(_annual,),
)


def _yoy(column: str) -> str:
    return (
        f"SELECT year, hours_of_data, {column}, previous_value, round({column} - previous_value, 2) AS yoy_change, "
        f"round(({column} - previous_value) / previous_value * 100, 2) AS yoy_pct_change FROM ("
        f"SELECT year, hours_of_data, {column}, lag({column}) OVER (ORDER BY year) AS previous_value FROM ("
        f"SELECT year, hours_of_data, round(CAST({column} AS DOUBLE), 2) AS {column} FROM annual))"
    )


add("yoy_change", "obs", _yoy("avg_volume"), more=(_annual,))
add("annual_total_yoy", "obs", _yoy("total_volume"), more=(_annual,))
add(
    "holiday_temperature",
    "obs",
    "SELECT h.holiday, h.year, h.holiday_date, count(*) AS hours_observed, avg(d.temp) AS avg_temp_k, min(d.temp) AS min_temp_k, "
    "max(d.temp) AS max_temp_k, avg(d.temp) - CAST(273.15 AS DOUBLE) AS avg_temp_c, min(d.temp) - CAST(273.15 AS DOUBLE) AS min_temp_c, "
    "max(d.temp) - CAST(273.15 AS DOUBLE) AS max_temp_c, avg(d.volume) AS avg_traffic "
    "FROM (SELECT DISTINCT holiday, CAST(date_time AS DATE) AS holiday_date, CAST(year(date_time) AS INT) AS year FROM obs "
    "WHERE holiday IN ('New Years Day', 'Labor Day')) h "
    "JOIN (SELECT date_time, avg(temp) AS temp, avg(traffic_volume) AS volume FROM obs GROUP BY 1) d "
    "ON CAST(d.date_time AS DATE) = h.holiday_date GROUP BY 1, 2, 3",
    "avg_temp_k min_temp_k max_temp_k avg_temp_c min_temp_c max_temp_c avg_traffic",
)
ORACLE["descriptive_stats"] = _with(
    "obs",
    "SELECT count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std_dev, round(var_samp(v), 3) AS variance, "
    "min(v) AS minimum, max(v) AS maximum, max(v) - min(v) AS value_range, median(v) AS median "
    "FROM (SELECT CAST(traffic_volume AS DOUBLE) AS v FROM obs)",
)
add(
    "temp_volume_correlation",
    "obs",
    "SELECT r, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction, CASE WHEN abs(r) < 0.1 THEN 'negligible' "
    "WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.5 THEN 'moderate' WHEN abs(r) < 0.7 THEN 'strong' ELSE 'very strong' END AS strength "
    "FROM (SELECT corr(traffic_volume, temp) AS r FROM obs)",
    "r",
)
_events_ab = (
    "events_ab",
    "SELECT count(*) AS n, count(*) FILTER (traffic_volume > 5500) AS n_a, count(*) FILTER (weather_main = 'Clear') AS n_b, "
    "count(*) FILTER (traffic_volume > 5500 AND weather_main = 'Clear') AS n_ab, "
    "count(*) FILTER (traffic_volume > 5500 AND temp > 292) AS n_warm FROM obs",
)
add(
    "congestion_probabilities",
    "obs",
    "SELECT n, n_a, n_b, n_ab, CAST(n_a AS DOUBLE) / n AS p_a, CAST(n_b AS DOUBLE) / n AS p_b, CAST(n_ab AS DOUBLE) / n AS p_ab FROM events_ab",
    "p_a p_b p_ab",
    more=(_events_ab,),
)
add(
    "conditional_probabilities",
    "obs",
    "SELECT coalesce(CAST(n_ab AS DOUBLE) / nullif(n_a, 0), 0) AS p_clear_given_congested, "
    "coalesce(CAST(n_warm AS DOUBLE) / nullif(n_a, 0), 0) AS p_warm_given_congested FROM events_ab",
    "p_clear_given_congested p_warm_given_congested",
    more=(_events_ab,),
)
add(
    "independence_test",
    "obs",
    "SELECT p_ab, p_a_times_p_b, abs(p_ab - p_a_times_p_b) AS difference, CASE WHEN abs(p_ab - p_a_times_p_b) < 0.005 "
    "THEN 'approximately independent' ELSE 'NOT independent (dependent)' END AS conclusion FROM "
    "(SELECT CAST(n_ab AS DOUBLE) / n AS p_ab, CAST(n_a AS DOUBLE) / n * n_b / n AS p_a_times_p_b FROM events_ab)",
    "p_ab p_a_times_p_b difference",
    more=(_events_ab,),
)


def _odds(source: str, event: str, group: str, first: str, second: str) -> str:
    return (
        "SELECT *, CASE WHEN odds_ratio > 1 THEN 'more likely in first' WHEN odds_ratio < 1 THEN 'more likely in second' "
        "WHEN odds_ratio = 1 THEN 'equal' ELSE 'undefined' END AS direction FROM ("
        "SELECT *, first_odds / nullif(second_odds, 0) AS odds_ratio FROM ("
        "SELECT *, CAST(first_hits AS DOUBLE) / nullif(first_misses, 0) AS first_odds, "
        "CAST(second_hits AS DOUBLE) / nullif(second_misses, 0) AS second_odds FROM ("
        f"SELECT count(*) FILTER ({group} = '{first}' AND {event}) AS first_hits, count(*) FILTER ({group} = '{second}' AND {event}) AS second_hits, "
        f"count(*) FILTER ({group} = '{first}' AND NOT {event}) AS first_misses, count(*) FILTER ({group} = '{second}' AND NOT {event}) AS second_misses "
        f"FROM {source})))"
    )


add("odds_ratio", "obs", _odds("obs", "traffic_volume > 5500", "weather_main", "Clear", "Clouds"), "first_odds second_odds odds_ratio")
add(
    "daily_trend",
    "obs",
    "SELECT CAST(year(day) AS INT) AS year, day, CAST(dayofyear(day) AS INT) AS day_of_year, avg_volume FROM "
    "(SELECT CAST(date_time AS DATE) AS day, avg(traffic_volume) AS avg_volume FROM obs WHERE year(date_time) BETWEEN 1998 AND 2000 GROUP BY 1)",
    "avg_volume",
)


def _hourly(source: str, ts: str, value: str, where: str = "true") -> str:
    return f"SELECT CAST(hour({ts}) AS INT) AS hour, avg({value}) AS avg_volume, count({value}) AS n FROM {source} WHERE {where} GROUP BY 1"


def _ranking(source: str, category: str, value: str) -> str:
    return (
        f"SELECT {category}, avg_volume, n, CAST(row_number() OVER (ORDER BY avg_volume DESC, {category}) AS INT) AS place, "
        f"first({category}) OVER w AS highest, last({category}) OVER w AS lowest, max(avg_volume) OVER () - min(avg_volume) OVER () AS value_range "
        f"FROM (SELECT {category}, avg({value}) AS avg_volume, count(*) AS n FROM {source} WHERE {category} IS NOT NULL GROUP BY 1) "
        f"WINDOW w AS (ORDER BY avg_volume DESC, {category} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    )


def _grid(source: str, row: str, columns: dict[str, str], value: str) -> str:
    cells = ", ".join(f"avg({value}) FILTER ({condition}) AS {name}" for name, condition in columns.items())
    return f"SELECT {row}, {cells} FROM {source} GROUP BY {row}"


_hours = {f"h{h:02d}": f"hour = {h}" for h in range(24)}
_days = {f'"{name}"': f"day_of_week = {i}" for i, name in enumerate(fv.DAY_NAMES)}
add("hourly_profile", "obs", _hourly("obs", "date_time", "traffic_volume", "year(date_time) = 2000"), "avg_volume")
add("category_ranking", "obs", _ranking("obs", "weather_main", "traffic_volume"), "avg_volume value_range")
add(
    "kpis",
    "obs",
    "SELECT count(*) AS total_hours, avg(traffic_volume) AS avg_volume, avg(temp - CAST(273.15 AS DOUBLE)) AS avg_temp_c FROM obs",
    "avg_volume avg_temp_c",
)
add(
    "hour_by_day_type",
    "timed",
    _grid("timed", "hour", {"weekday": "is_weekend = 0", "weekend": "is_weekend = 1"}, "traffic_volume"),
    "weekday weekend",
)
add("dow_hour_heatmap", "timed", _grid("timed", "day_of_week", _hours, "traffic_volume"), " ".join(_hours))
add("hour_dow_heatmap", "timed", _grid("timed", "hour", _days, "traffic_volume"), " ".join(_days))


def _histogram(source: str, column: str, bins: int) -> str:
    return (
        f"SELECT CAST(b.bin AS INT) AS bin, lo + b.bin * (hi - lo) / {bins} AS lower, lo + (b.bin + 1) * (hi - lo) / {bins} AS upper, "
        f"coalesce(c.n, 0) AS n FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN "
        f"(SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}) e LEFT JOIN "
        f"(SELECT least(CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS INT), {bins - 1}) AS bin, count(*) AS n FROM {source}, "
        f"(SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}) GROUP BY 1) c ON b.bin = c.bin"
    )


add("volume_histogram", "cleaned", _histogram("cleaned", "traffic_volume", 50), "lower upper")
_long = (
    "long_rows",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, split, CAST({f} AS DOUBLE) AS value FROM labelled WHERE split IN ('train', 'production') AND {f} IS NOT NULL"
        for f in fv.DRIFT_FEATURES
    ),
)
add(
    "drift_histogram",
    "labelled",
    "SELECT e.feature, e.split, CAST(b.bin AS INT) AS bin, lo + b.bin * (hi - lo) / 50 AS lower, lo + (b.bin + 1) * (hi - lo) / 50 AS upper, "
    "coalesce(c.n, 0) AS n, coalesce(c.n, 0) / (total * ((hi - lo) / 50)) AS density FROM edges e CROSS JOIN (SELECT unnest(range(50)) AS bin) b "
    "LEFT JOIN (SELECT l.feature, l.split, least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT), 49) AS bin, count(*) AS n "
    "FROM long_rows l JOIN edges x ON l.feature = x.feature AND l.split = x.split GROUP BY 1, 2, 3) c "
    "ON c.feature = e.feature AND c.split = e.split AND c.bin = b.bin",
    "lower upper density",
    more=(
        _long,
        (
            "edges",
            "SELECT feature, split, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo, "
            "CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi, count(*) AS total FROM long_rows GROUP BY 1, 2",
        ),
    ),
)
add(
    "top_weather_scatter",
    "cleaned",
    "SELECT weather_main, temp, traffic_volume FROM cleaned WHERE weather_main IN "
    "(SELECT weather_main FROM cleaned GROUP BY 1 ORDER BY count(*) DESC, weather_main LIMIT 5)",
    "temp traffic_volume",
)
add(
    "hourly_stats",
    "labelled",
    "SELECT day_type, weather_category, hour, avg(traffic_volume) AS mean, stddev_samp(traffic_volume) AS std, count(traffic_volume) AS count, "
    "quantile_cont(traffic_volume, 0.25) AS p25, median(traffic_volume) AS median, quantile_cont(traffic_volume, 0.75) AS p75 "
    "FROM labelled GROUP BY 1, 2, 3",
    "mean std p25 median p75",
)
add(
    "weekday_weekend_compare",
    "timed",
    "SELECT CAST(month(date_time) AS INT) AS month, monthname(date_time) AS month_name, avg(traffic_volume) FILTER (is_weekend = 0) AS weekday_avg, "
    "avg(traffic_volume) FILTER (is_weekend = 1) AS weekend_avg, "
    "avg(traffic_volume) FILTER (is_weekend = 0) - avg(traffic_volume) FILTER (is_weekend = 1) AS difference FROM timed GROUP BY 1, 2",
    "weekday_avg weekend_avg difference",
)


def _gaps(source: str, ts: str, hours: int) -> str:
    return (
        f"SELECT * FROM (SELECT lag({ts}) OVER (ORDER BY {ts}) AS gap_start, {ts} AS gap_end, "
        f"epoch({ts} - lag({ts}) OVER (ORDER BY {ts})) / 3600.0 AS gap_hours FROM (SELECT DISTINCT {ts} FROM {source})) WHERE gap_hours > {hours}"
    )


add("coverage_gaps", "obs", _gaps("obs", "date_time", 1), "gap_hours")
add(
    "category_counts",
    "labelled",
    "SELECT congestion_category, count(*) AS n, count(*) FILTER (high_risk = 1) AS high_risk_n, avg(CAST(high_risk AS DOUBLE)) AS high_risk_rate "
    "FROM labelled GROUP BY 1",
    "high_risk_rate",
)


# --- travel advice
def _means_of(keys: str, where: str = "true") -> str:
    return f"SELECT {keys}, hour, avg(traffic_volume) AS mean_volume FROM labelled WHERE {where} GROUP BY {keys}, hour"


def _below_peak(keys: str, source: str) -> str:
    return (
        f"SELECT *, CASE WHEN peak_volume > 0 THEN (1 - mean_volume / peak_volume) * 100 ELSE 0 END AS pct_below_peak FROM ("
        f"SELECT *, max(mean_volume) OVER (PARTITION BY {keys}) AS peak_volume, "
        f"first(hour) OVER (PARTITION BY {keys} ORDER BY mean_volume DESC, hour) AS peak_hour FROM {source})"
    )


def _best(keys: str, where: str, n: int) -> str:
    inside = (
        f"SELECT * EXCLUDE (inside) FROM (SELECT *, bool_or(hour BETWEEN 6 AND 22) OVER (PARTITION BY {keys}) AS inside "
        f"FROM ({_means_of(keys, where)})) WHERE hour BETWEEN 6 AND 22 OR NOT inside"
    )
    ranked = (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY mean_volume, hour) AS INT) AS place "
        f"FROM ({_below_peak(keys, f'({inside})')})"
    )
    return f"SELECT * FROM ({ranked}) WHERE place <= {n}"


def _hour(h: str) -> str:
    return f"(CASE WHEN {h} % 12 = 0 THEN '12' ELSE CAST({h} % 12 AS VARCHAR) END || ':00 ' || CASE WHEN {h} < 12 THEN 'AM' ELSE 'PM' END)"


_span = f"{_hour('hour')} || ' – ' || {_hour('((hour + 1) % 24)')}"
_advice = (
    "'For a ' || day_type || ' journey in ' || lower(weather_category) || ' weather, consider travelling between ' || "
    f"{_span} || ', when traffic is typically ~' || format('{{:,.0f}}', mean_volume) || ' vehicles/hour (' || "
    f"format('{{:.0f}}', pct_below_peak) || '% below the ' || {_hour('peak_hour')} || ' peak).'"
)
_warning = (
    f"'Avoid travelling between ' || {_span} || ' on ' || day_type || 's — average volume reaches ' || "
    "format('{:,.0f}', mean_volume) || ' vehicles/hour.'"
)


def _peaks(n: int) -> str:
    return (
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY day_type ORDER BY mean_volume DESC, hour) AS INT) AS place "
        f"FROM ({_means_of('day_type')})) WHERE place <= {n}"
    )


_pair = "day_type, weather_category"
add("pct_below_peak", "labelled", _below_peak(_pair, f"({_means_of(_pair)})"), "mean_volume peak_volume pct_below_peak")
add("peak_hours", "labelled", f"SELECT day_type, place, hour, mean_volume FROM ({_peaks(5)})", "mean_volume")
add(
    "best_hours_exact",
    "labelled",
    _best("day_type, weather_main", "day_type = 'weekday' AND weather_main = 'Rain'", 5),
    "mean_volume peak_volume pct_below_peak",
)
_worded = "SELECT day_type, weather_category, place, hour, round_even(mean_volume, 1) AS mean_volume, {text} AS message FROM ({best})"
add(
    "recommend_travel_time",
    "labelled",
    _worded.format(text=_advice, best=_best(_pair, "day_type = 'weekend' AND weather_category = 'Fog'", 3)),
)
add(
    "recommendation_report",
    "labelled",
    f"SELECT 'peak' AS section, day_type, 'all' AS weather_category, place, hour, round_even(mean_volume, 1) AS mean_volume, {_warning} AS message "
    f"FROM ({_peaks(3)}) UNION ALL SELECT 'advice' AS section, * FROM ({_worded.format(text=_advice, best=_best(_pair, 'true', 3))})",
)

# --- features
add("minmax_scale", "featured", "SELECT date_time, temp_norm, clouds_all_norm, rain_1h_norm FROM featured", "temp_norm clouds_all_norm rain_1h_norm")
add("quartile_category", "featured", "SELECT date_time, traffic_volume, congestion_category FROM featured")
_cyclic = "hour_sin hour_cos dow_sin dow_cos"
add(
    "time_features",
    "featured",
    "SELECT date_time, hour, day_of_week, is_weekend, hour_sin, hour_cos, dow_sin, dow_cos FROM featured",
    _cyclic,
)
add(
    "one_hot_weather",
    "featured",
    "SELECT date_time, weather_main, " + ", ".join(f'"weather_{c}"' for c in fv.WEATHER_CATEGORIES) + " FROM featured",
)
add(
    "weather_indicators",
    "featured",
    "SELECT date_time, weather_main, clouds_all, is_rainy, is_snowy, is_low_visibility, CAST(weather_severity AS INT) AS weather_severity FROM featured",
    "clouds_all",
)
add(
    "feature_pipeline",
    "featured",
    "SELECT * REPLACE (CAST(weather_severity AS INT) AS weather_severity) FROM featured",
    "temp rain_1h snow_1h clouds_all traffic_volume temp_norm clouds_all_norm rain_1h_norm " + _cyclic,
)
_inputs = fv.BASE_FEATURES + [f"weather_{c}" for c in fv.WEATHER_CATEGORIES]
add(
    "feature_columns",
    "featured",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS position, '{c}' AS name, count(\"{c}\") AS n_values FROM featured" for i, c in enumerate(_inputs)
    ),
)
add(
    "proxy_label",
    "labelled",
    "SELECT count(*) AS n, CAST(sum(high_risk) AS BIGINT) AS high_risk_n, avg(CAST(high_risk AS DOUBLE)) AS high_risk_rate FROM labelled",
    "high_risk_rate",
)
add("time_of_day_band", "timed", f"SELECT hour, {DAY_PART} AS time_of_day, count(*) AS n FROM timed GROUP BY 1, 2")
add("day_type", "timed", f"SELECT day_of_week, {DAY_TYPE} AS day_type, count(*) AS n FROM timed GROUP BY 1, 2")

# --- learning
add(
    "chronological_split",
    "labelled",
    "SELECT split, count(*) AS n, min(date_time) AS first_record, max(date_time) AS last_record FROM labelled GROUP BY 1",
)
_parts = (
    "parts",
    "SELECT *, CASE WHEN row_number() OVER (ORDER BY date_time) <= count(*) OVER () - ceil(count(*) OVER () * 0.2) THEN 'fit' ELSE 'holdout' END AS part "
    "FROM labelled WHERE split = 'train'",
)
add("holdout_tail_split", "labelled", "SELECT date_time, part FROM parts", more=(_parts,))
_scaled = ["temp", "rain_1h", "clouds_all", "hour_sin"]
add(
    "standard_scale",
    "labelled",
    "SELECT date_time, "
    + ", ".join(f"({c} - {c}_m) / CASE WHEN {c}_s > 0 THEN {c}_s ELSE 1 END AS {c}_z" for c in _scaled)
    + " FROM labelled, (SELECT "
    + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _scaled)
    + " FROM labelled WHERE split = 'train')",
    " ".join(f"{c}_z" for c in _scaled),
)
add(
    "class_weights",
    "labelled",
    "SELECT high_risk, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE)) AS weight "
    "FROM labelled WHERE split = 'train' GROUP BY 1",
    "weight",
)
_volume_test = (
    "scored",
    "SELECT l.*, coalesce(g.m, (SELECT avg(traffic_volume) FROM labelled WHERE split = 'train')) AS prediction FROM labelled l LEFT JOIN "
    "(SELECT hour, is_weekend, avg(traffic_volume) AS m FROM labelled WHERE split = 'train' GROUP BY 1, 2) g "
    "ON l.hour = g.hour AND l.is_weekend = g.is_weekend WHERE l.split = 'test'",
)
_risk_test = (
    "scored",
    "SELECT *, CAST(score > 0.5 AS INT) AS prediction FROM (SELECT l.*, "
    "coalesce(g.m, (SELECT avg(CAST(high_risk AS DOUBLE)) FROM labelled WHERE split = 'train')) AS score FROM labelled l LEFT JOIN "
    "(SELECT weather_main, hour, avg(CAST(high_risk AS DOUBLE)) AS m FROM labelled WHERE split = 'train' GROUP BY 1, 2) g "
    "ON l.weather_main = g.weather_main AND l.hour = g.hour WHERE l.split = 'test')",
)
add(
    "regression_metrics",
    "labelled",
    "SELECT count(*) AS n, avg(abs(traffic_volume - prediction)) AS mae, "
    "1 - sum((traffic_volume - prediction) ** 2) / sum((traffic_volume - (SELECT avg(traffic_volume) FROM scored)) ** 2) AS r2 FROM scored",
    "mae r2",
    more=(_volume_test,),
)
add(
    "classification_metrics",
    "labelled",
    "SELECT n, CAST(tp + tn AS DOUBLE) / n AS accuracy, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS \"precision\", "
    "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, "
    "(SELECT (sum(r) FILTER (high_risk = 1) - CAST(count(*) FILTER (high_risk = 1) AS DOUBLE) * (count(*) FILTER (high_risk = 1) + 1) / 2) "
    "/ (CAST(count(*) FILTER (high_risk = 1) AS DOUBLE) * count(*) FILTER (high_risk = 0)) FROM "
    "(SELECT high_risk, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)) AS roc_auc "
    "FROM (SELECT count(*) AS n, count(*) FILTER (high_risk = 1 AND prediction = 1) AS tp, count(*) FILTER (high_risk = 0 AND prediction = 1) AS fp, "
    "count(*) FILTER (high_risk = 1 AND prediction = 0) AS fn, count(*) FILTER (high_risk = 0 AND prediction = 0) AS tn FROM scored)",
    'accuracy "precision" recall f1 roc_auc',
    more=(_risk_test,),
)
add(
    "confusion_matrix",
    "labelled",
    " UNION ALL ".join(
        f"SELECT CAST({a} AS INT) AS actual, CAST({p} AS INT) AS predicted, count(*) AS n FROM scored WHERE high_risk = {a} AND prediction = {p}"
        for a in (0, 1)
        for p in (0, 1)
    ),
    more=(_risk_test,),
)
add(
    "error_by_slice",
    "labelled",
    " UNION ALL ".join(
        f"SELECT '{name}' AS slice, CAST({c} AS VARCHAR) AS value, avg(abs(traffic_volume - prediction)) AS mae, count(*) AS n FROM scored GROUP BY {c}"
        for name, c in (("hour", "hour"), ("weather", "weather_main"), ("quarter", "quarter(date_time)"))
    ),
    "mae",
    more=(_volume_test,),
)
_rules = (
    "SELECT antecedent, consequent, CAST(n AS DOUBLE) / total AS support, CAST(n AS DOUBLE) / n_left AS confidence, "
    "(CAST(n AS DOUBLE) / n_left) / (CAST(n_right AS DOUBLE) / total) AS lift FROM ("
    "SELECT concat_ws(',', nullif(c.d, ''), nullif(c.t, ''), nullif(c.w, '')) AS antecedent, c.g AS consequent, c.n, a.n AS n_left, g.n AS n_right, "
    "(SELECT max(n) FROM cells) AS total FROM cells c "
    "JOIN cells a ON a.g = '' AND a.t = c.t AND a.d = c.d AND a.w = c.w "
    "JOIN cells g ON g.g = c.g AND g.t = '' AND g.d = '' AND g.w = '' WHERE c.g <> '' AND (c.t <> '' OR c.d <> '' OR c.w <> '')) "
    "WHERE n >= 0.01 * total AND (CAST(n AS DOUBLE) / n_left) / (CAST(n_right AS DOUBLE) / total) >= 1"
)
_cells = (
    "cells",
    f"SELECT coalesce(t, '') AS t, coalesce(d, '') AS d, coalesce(w, '') AS w, coalesce(g, '') AS g, count(*) AS n FROM (SELECT 'time=' || {DAY_PART} AS t, 'day=' || {DAY_TYPE} AS d, 'weather=' || {BUCKET} AS w, "
    "'congestion=' || congestion_category AS g FROM featured) GROUP BY CUBE (t, d, w, g)",
)
add(
    "linear_coefficients",
    "labelled",
    "SELECT m.y - b1 * m.x1 - b2 * m.x2 AS intercept, b1 AS hour_cos, b2 AS is_weekend FROM (SELECT *, (v2 * c1 - c12 * c2) / (v1 * v2 - c12 * c12) AS b1, "
    "(v1 * c2 - c12 * c1) / (v1 * v2 - c12 * c12) AS b2 FROM (SELECT avg(traffic_volume) AS y, avg(hour_cos) AS x1, avg(is_weekend) AS x2, "
    "var_pop(hour_cos) AS v1, var_pop(is_weekend) AS v2, covar_pop(hour_cos, is_weekend) AS c12, covar_pop(hour_cos, traffic_volume) AS c1, "
    "covar_pop(is_weekend, traffic_volume) AS c2 FROM labelled WHERE split = 'train')) m",
    "intercept hour_cos is_weekend",
    4,
)
_scaled = (
    "scaled",
    "SELECT hour, weather_severity, traffic_volume, "
    + ", ".join(f"(CAST({c} AS DOUBLE) - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS s{i}" for i, c in enumerate(fv.CLUSTER_FEATURES))
    + " FROM featured WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in fv.CLUSTER_FEATURES),
)
_nearest = (
    "nearest",
    "SELECT *, list_min(["
    + ", ".join(
        "{'d': " + " + ".join(f"(s{j} - {x}::DOUBLE) * (s{j} - {x}::DOUBLE)" for j, x in enumerate(centre)) + f", 'i': {i}}}"
        for i, centre in enumerate(fv.REFERENCE_CENTRES)
    )
    + "]).i AS prediction FROM scaled",
)
_name = (
    f"CASE WHEN mean_volume < {fv.LULL_BELOW} THEN 'Night lull' WHEN mean_volume < {fv.SHOULDER_BELOW} AND (mean_hour > {fv.SHOULDER_HOURS[1]} "
    f"OR mean_hour < {fv.SHOULDER_HOURS[0]}) THEN 'Shoulder hours' WHEN mean_volume >= {fv.PEAK_FROM} THEN 'Peak commute' ELSE 'Midday moderate' END"
)
add(
    "centre_profiles",
    "featured",
    f"SELECT *, {_case('name', fv.CLUSTER_ACTIONS, 'NULL')} AS action FROM (SELECT *, {_name} AS name FROM (SELECT "
    "CAST(row_number() OVER (ORDER BY mean_volume, prediction) - 1 AS INT) AS cluster, size, mean_hour, mean_severity, mean_volume FROM "
    "(SELECT prediction, count(*) AS size, avg(hour) AS mean_hour, avg(weather_severity) AS mean_severity, avg(traffic_volume) AS mean_volume "
    "FROM nearest GROUP BY 1)))",
    "mean_hour mean_severity mean_volume",
    more=(_scaled, _nearest),
)
_bad_request = " OR ".join(f"k % {m} = {r}" for m, r in ((701, 1), (709, 2), (719, 3), (727, 4), (733, 5), (739, 6), (743, 7)))
add(
    "baseline_score",
    "labelled",
    "SELECT k AS request_id, round(m, 2) AS predicted_traffic_volume, CASE WHEN m <= q1 THEN 'low' WHEN m <= q2 THEN 'moderate' WHEN m <= q3 THEN 'high' "
    f"ELSE 'very_high' END AS congestion_level FROM (SELECT o_orderkey AS k FROM orders) JOIN (SELECT hour, is_weekend, avg(traffic_volume) AS m "
    f"FROM labelled WHERE split = 'train' GROUP BY 1, 2) ON hour = k % 24 AND is_weekend = CAST(k % 7 >= 5 AS INT), ({_quartiles}) WHERE NOT ({_bad_request})",
)
_weighed = (
    "points",
    "SELECT hour_cos AS x1, CAST(is_weekend AS DOUBLE) AS x2, CAST(high_risk AS DOUBLE) AS y, count(*) * any_value(w) AS w FROM (SELECT *, "
    "count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY high_risk)) AS w FROM labelled WHERE split = 'train') GROUP BY ALL",
)
_newton = (
    "newton(i, b0, b1, b2, g0, g1, g2)",
    "SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL SELECT i + 1, "
    "b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det, "
    "b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det, "
    "b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det, g0, g1, g2 FROM ("
    "SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM ("
    "SELECT i, b0, b1, b2, sum(w * (p - y)) AS g0, sum(w * (p - y) * x1) + b1 AS g1, sum(w * (p - y) * x2) + b2 AS g2, sum(w * p * (1 - p)) AS h00, "
    "sum(w * p * (1 - p) * x1) AS h01, sum(w * p * (1 - p) * x2) AS h02, sum(w * p * (1 - p) * x1 * x1) + 1 AS h11, "
    "sum(w * p * (1 - p) * x1 * x2) AS h12, sum(w * p * (1 - p) * x2 * x2) + 1 AS h22 FROM ("
    "SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM newton, points WHERE i < 15) GROUP BY i, b0, b1, b2))",
)
add(
    "logistic_newton",
    "labelled",
    " UNION ALL ".join(f"SELECT '{t}' AS term, b{k} AS coefficient, abs(g{k}) AS gradient FROM newton WHERE i = 15" for k, t in enumerate(("intercept", "hour_cos", "is_weekend"))),
    "coefficient gradient",
    4,
    more=(_weighed, _newton),
)
_scaled_points = (
    "points",
    "SELECT x0, x1, x2, x3, count(*) AS n FROM (SELECT "
    + ", ".join(f"round((CAST({c} AS DOUBLE) - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS x{i}" for i, c in enumerate(fv.CLUSTER_FEATURES))
    + " FROM featured WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in fv.CLUSTER_FEATURES)
    + ") GROUP BY ALL",
)
_squares = "list_transform(centres, lambda c: (x0 - c[1]) * (x0 - c[1]) + (x1 - c[2]) * (x1 - c[2]) + (x2 - c[3]) * (x2 - c[3]) + (x3 - c[4]) * (x3 - c[4]))"
_point_key = " || ',' || ".join(f"CAST(CAST(round(x{i} * 1000000) AS BIGINT) AS VARCHAR)" for i in range(4))
_seeds = (
    "seeds(step, restart, centres)",
    "SELECT 0, CAST(range AS INT), CAST([] AS DOUBLE[][]) FROM range(10) UNION ALL SELECT step + 1, restart, list_append(any_value(centres), "
    "arg_min([x0, x1, x2, x3], -ln(even) / rate)) FROM (SELECT *, (CAST(('0x' || md5('42:4:' || restart || ':' || step || ':' || "
    f"{_point_key})[1:13]) AS BIGINT) + 1) / 4503599627370496.0::DOUBLE AS even, n * CASE WHEN step = 0 THEN 1 ELSE list_min({_squares}) END AS rate "
    "FROM seeds, points WHERE step < 4) WHERE rate > 0 GROUP BY step, restart",
)
_lloyd = (
    "lloyd(i, restart, centres)",
    "SELECT 0, restart, centres FROM seeds WHERE step = 4 UNION ALL SELECT i + 1, restart, list_transform([1, 2, 3, 4], lambda j: coalesce(fresh[j], centres[j])) "
    "FROM (SELECT i, restart, any_value(centres) AS centres, map_from_entries(list({'k': cluster, 'v': c})) AS fresh FROM ("
    "SELECT i, restart, any_value(centres) AS centres, CAST(list_position(d, list_min(d)) AS INT) AS cluster, [sum(n * x0) / sum(n), sum(n * x1) / sum(n), sum(n * x2) / sum(n), sum(n * x3) / sum(n)] AS c "
    f"FROM (SELECT *, {_squares} AS d FROM lloyd, points WHERE i < 30) GROUP BY i, restart, CAST(list_position(d, list_min(d)) AS INT)) GROUP BY i, restart)",
)
_costs = (
    "costs",
    f"SELECT restart, cluster, any_value(centres)[cluster] AS c, sum(n) AS size, sum(n * least_) AS own FROM (SELECT *, list_min(d) AS least_, list_position(d, list_min(d)) AS cluster "
    f"FROM (SELECT *, {_squares} AS d FROM lloyd, points WHERE i = 30)) GROUP BY restart, cluster",
)
add(
    "kmeans_seeded",
    "featured",
    "SELECT CAST(4 AS INT) AS k, restart, CAST(row_number() OVER (ORDER BY round(c[1], 9), round(c[2], 9), round(c[3], 9), round(c[4], 9)) - 1 AS INT) AS cluster, CAST(size AS BIGINT) AS size, "
    "(sum(own) OVER ()) AS cost, c[1] AS c0, c[2] AS c1, c[3] AS c2, c[4] AS c3 FROM costs WHERE restart = "
    "(SELECT restart FROM costs GROUP BY restart ORDER BY round(sum(own), 9), restart LIMIT 1)",
    "cost c0 c1 c2 c3",
    more=(_scaled_points, _seeds, _lloyd, _costs),
)
for _key in ("logistic_newton", "kmeans_seeded"):
    ORACLE[_key] = ORACLE[_key].replace("WITH ", "WITH RECURSIVE ", 1)
add("association_rules", "featured", _rules, "support confidence lift", more=(_cells,))
add(
    "top_association_rules",
    "featured",
    f"SELECT * FROM ({_rules}) ORDER BY lift DESC, antecedent, consequent LIMIT 5",
    "support confidence lift",
    more=(_cells,),
)
ORACLE["stream_baseline"] = ORACLE["baseline_score"]
ORACLE["validate_requests"] = """
SELECT request_id, problems = '' AS is_valid, problems FROM (
SELECT k AS request_id, concat_ws(',',
 CASE WHEN k % 701 = 1 THEN 'hour' END, CASE WHEN k % 709 = 2 THEN 'day_of_week' END, CASE WHEN k % 719 = 3 THEN 'is_weekend' END,
 CASE WHEN k % 727 = 4 THEN 'rain_1h' END, CASE WHEN k % 733 = 5 THEN 'snow_1h' END, CASE WHEN k % 739 = 6 THEN 'clouds_all' END,
 CASE WHEN k % 743 = 7 THEN 'is_holiday' END,
 CASE WHEN k % 719 = 3 OR (k % 709 = 2 AND k % 7 < 5) THEN 'weekend_mismatch' END) AS problems
FROM (SELECT o_orderkey AS k FROM orders))"""

# --- drift
_shares = (
    "shares",
    "SELECT feature, value, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb "
    "FROM (SELECT feature, value, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'production') AS b FROM long_rows GROUP BY 1, 2) "
    "WINDOW w AS (PARTITION BY feature ORDER BY value)",
)
_ks = (
    "SELECT feature, CAST(max(na) AS BIGINT) AS n_first, CAST(max(nb) AS BIGINT) AS n_second, "
    "max(abs(CAST(ca AS DOUBLE) / na - CAST(cb AS DOUBLE) / nb)) AS ks_statistic FROM shares GROUP BY 1"
)
_monitored = (
    "monitored",
    "SELECT p.*, coalesce(g.m, (SELECT avg(traffic_volume) FROM parts WHERE part = 'fit')) AS prediction FROM "
    "(SELECT * FROM parts UNION ALL SELECT *, 'production' FROM labelled WHERE split = 'production') p LEFT JOIN "
    "(SELECT hour, is_weekend, avg(traffic_volume) AS m FROM parts WHERE part = 'fit' GROUP BY 1, 2) g "
    "ON p.hour = g.hour AND p.is_weekend = g.is_weekend",
)
_error = (
    "error_drift",
    "SELECT holdout_mae, production_mae, (production_mae - holdout_mae) / holdout_mae * 100 AS pct_change, "
    "CASE WHEN (production_mae - holdout_mae) / holdout_mae > 0.2 THEN 'ALERT' ELSE 'PASS' END AS status, "
    "CASE WHEN production_mae < holdout_mae THEN 'error decreased' ELSE '' END AS note FROM "
    "(SELECT avg(abs(traffic_volume - prediction)) FILTER (part = 'holdout') AS holdout_mae, "
    "avg(abs(traffic_volume - prediction)) FILTER (part = 'production') AS production_mae FROM monitored)",
)
add("prediction_error_drift", "labelled", "SELECT * FROM error_drift", "holdout_mae production_mae pct_change", more=(_parts, _monitored, _error))
# The tail of the limit law, summed term by term, at the corrected argument.
_tested = (
    "tested",
    "SELECT feature, ks_statistic, CASE WHEN ks_statistic <= 0 THEN 1 ELSE (SELECT 2 * sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * x * x)) "
    "FROM (SELECT unnest(range(1, 2001)) AS k)) END AS p FROM (SELECT *, d + 1 / (6 * root) + (d - 1) / (4 * root * root) AS x FROM "
    f"(SELECT *, root * ks_statistic AS d FROM (SELECT *, sqrt(CAST(n_first AS DOUBLE) * n_second / (n_first + n_second)) AS root FROM ({_ks}))))",
)
add(
    "feature_drift_ks",
    "labelled",
    "SELECT feature, n_first, n_second, ks_statistic, p AS p_value, CASE WHEN p < 0.05 THEN 'ALERT' ELSE 'PASS' END AS status FROM tested",
    "ks_statistic p_value",
    more=(_long, _shares, ("tested", _tested[1].replace("SELECT feature, ks_statistic,", "SELECT feature, n_first, n_second, ks_statistic,", 1))),
)
_checks = (
    "checks",
    "SELECT 'feature_drift' AS \"check\", feature AS name, ks_statistic AS statistic, CASE WHEN p < 0.05 THEN 'ALERT' ELSE 'PASS' END AS status FROM tested "
    "UNION ALL SELECT 'prediction_error', 'mae', pct_change, status FROM error_drift",
)
add(
    "monitoring_summary",
    "labelled",
    "SELECT * FROM checks UNION ALL SELECT 'overall', 'alerts', CAST(count(*) FILTER (status = 'ALERT') AS DOUBLE), "
    "CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT' ELSE 'PASS' END FROM checks",
    "statistic",
    more=(_long, _shares, _parts, _monitored, _error, _tested, _checks),
)

add(
    "drift_status_json",
    "labelled",
    "SELECT o.overall_status, CASE o.overall_status WHEN 'ALERT' THEN 'ALERT / Requires investigation' ELSE 'PASS / Normal' END AS overall_message, "
    "e.status AS error_status, round(e.holdout_mae, 2) AS holdout_mae, round(e.production_mae, 2) AS production_mae, round(e.pct_change, 2) AS pct_change, "
    "t.feature, CASE WHEN t.p < 0.05 THEN 'ALERT' ELSE 'PASS' END AS status, round(t.ks_statistic, 4) AS ks_statistic, round(t.p, 4) + 0.0 AS p_value "
    "FROM tested t, error_drift e, (SELECT CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT' ELSE 'PASS' END AS overall_status FROM checks) o",
    more=(_long, _shares, _parts, _monitored, _error, _tested, _checks),
)

# --- the same operators on other tables
add("events_hourly_profile", None, _hourly("events", "ts", "value"), "avg_volume", 4)
add(
    "events_dow_hour_heatmap",
    None,
    _grid("(SELECT CAST(isodow(ts) - 1 AS INT) AS day_of_week, hour(ts) AS hour, value FROM events)", "day_of_week", _hours, "value"),
    " ".join(_hours),
    4,
)
add("events_category_ranking", None, _ranking("events", "event_type", "value"), "avg_volume value_range", 4)
add(
    "lineitem_descriptive_stats",
    None,
    "SELECT count(l_quantity) AS n, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS std_dev, var_samp(l_quantity) AS variance, "
    "min(l_quantity) AS minimum, max(l_quantity) AS maximum, max(l_quantity) - min(l_quantity) AS value_range, median(l_quantity) AS median FROM lineitem",
    "mean std_dev variance",
)
add("lineitem_histogram", None, _histogram("lineitem", "l_quantity", 20), "lower upper")
add("lineitem_odds_ratio", None, _odds("lineitem", "l_quantity > 40", "l_returnflag", "R", "A"), "first_odds second_odds odds_ratio")
add("events_gaps", None, _gaps("events", "ts", 0.05), "gap_hours")
add("lineitem_shipdate_gaps", None, _gaps("lineitem", "l_shipdate", 12), "gap_hours")
