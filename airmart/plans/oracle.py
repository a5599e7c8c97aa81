"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle re-derives the readings from ``events``/``customer``/``nation``
with the adapter formulas and re-implements each layer in plain SQL, sharing
no code with the Spark side. Conventions that make the two comparable:

* averages are rounded HALF_UP from the exact integer sum
  (``sign(s) * ((2|s| + n) // 2n)``), not from DuckDB's DOUBLE ``avg``;
* MODE is ``first(v ORDER BY count DESC, v)``: the most frequent value, ties
  to the smallest (DuckDB's own ``mode`` keeps the first seen);
* hash keys are not comparable across engines, so star joins use the natural
  keys with ``IS NOT DISTINCT FROM`` and key columns are left out;
* decimals leave as DOUBLE and integers as BIGINT, as on the Spark side.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong list on the Spark side shows.
LOWERCASE_WORDS = ("de", "del", "la", "las", "el", "los", "y", "e", "a", "al")
COUNTRIES = ("peru", "singapore", "india", "united_states", "united_kingdom")
CITIES = ("lima", "singapore", "new_delhi", "new_york", "ciudad_de_londres")
TIMEZONES = ("America/Lima", "Asia/Singapore", "Asia/Kolkata", "America/New_York", "Europe/London")
DISTRICTS = ("santa_anita", "san_juan_de_lurigancho", "villa_el_salvador")
WIND_DIRS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
COPY_USER, COPY_ROLE = "fixture_loader", "SYSADMIN"

FIXED_NOW = "2024-02-01 00:00:00"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def rnd(col: str, digits: int, scale: int) -> str:
    """HALF_UP rounded mean of a DECIMAL(.., scale) / integer column, as DOUBLE."""
    s = f"CAST(sum({col}) * {10 ** scale} AS HUGEINT)"
    n = f"CAST(count({col}) AS HUGEINT)"
    if digits >= scale:
        num, den = f"({s} * {10 ** (digits - scale)})", n
    else:
        num, den = s, f"({n} * {10 ** (scale - digits)})"
    q = f"((2 * abs({num}) + {den}) // (2 * {den}))"
    return (f"(CASE WHEN count({col}) = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN {num} < 0 THEN -1 ELSE 1 END) * {q} AS DOUBLE) / {10 ** digits} END)")


def rnd_dec(col: str, digits: int, scale: int, width: int = 10) -> str:
    """Same rounding kept as DECIMAL for the next layer."""
    return f"CAST({rnd(col, digits, scale)} AS DECIMAL({width},{digits}))"


def fmt(col: str) -> str:
    words = ", ".join(f"'{w}'" for w in LOWERCASE_WORDS)
    return (f"(CASE WHEN {col} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"list_filter(regexp_split_to_array(replace({col}, '_', ' '), '\\s+'), lambda w: w <> ''), "
            f"lambda w, i: CASE WHEN i = 1 OR lower(w) NOT IN ({words}) "
            f"THEN upper(w[1]) || lower(w[2:]) ELSE lower(w) END), ' ') END)")


def cents(x: str, typ: str = "DECIMAL(10,2)") -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * 0.01 AS {typ})"


def mode_expr(col: str, cnt: str) -> str:
    return f"first({col} ORDER BY {cnt} DESC, {col}) FILTER (WHERE {col} IS NOT NULL)"


def pollutant_metrics(p=("pm2_5", "pm10", "so2", "no2", "co", "o3")) -> dict:
    z = [f"coalesce({c}, 0)" for c in p]
    g = f"greatest({', '.join(z)})"
    labels = ("PM2.5", "PM10", "SO2", "NO2", "CO", "O3")
    prom = "CASE " + " ".join(f"WHEN {zc} = {g} THEN '{lab}'" for zc, lab in zip(z, labels)) + " END"
    pos = [f"(CASE WHEN {c} > 0 THEN 1 ELSE 0 END)" for c in p[2:]]
    crit = (f"((CASE WHEN {p[0]} > 0 OR {p[1]} > 0 THEN 1 ELSE 0 END) + least(2, {' + '.join(pos)}))")
    aqi = f"CAST(CASE WHEN {crit} >= 3 THEN {g} ELSE 0 END AS DECIMAL(10,2))"
    valid = (f"(CASE WHEN {p[0]} IS NULL AND {p[1]} IS NULL THEN FALSE "
             f"WHEN {crit} >= 3 THEN TRUE ELSE FALSE END)")
    return {"prominent": prom, "criteria": crit, "custom_aqi": aqi, "valid": valid}


def _ctes() -> dict:
    pm = pollutant_metrics()
    flat = f"""
src AS (
  SELECT e.event_id AS k, e.ts, e.event_type, n.n_regionkey AS g, e.user_id % 3 AS d,
         CAST(round(e.value * 100) AS BIGINT) AS c, CAST(floor(epoch(e.ts)) AS BIGINT) AS secs
  FROM events e JOIN customer cu ON cu.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = cu.c_nationkey
),
src2 AS (
  SELECT *, (secs // 900) * 900 AS me,
         {_list(COUNTRIES)}[g + 1] AS country_slug, {_list(CITIES)}[g + 1] AS city_slug,
         {_list(DISTRICTS)}[d + 1] AS district_slug
  FROM src
),
flat AS (
  SELECT make_timestamp(me * 1000000) AS measurement_ts, me AS measurement_epoch,
    make_timestamp(secs * 1000000) AS request_ts, secs AS request_epoch,
    'loc_' || g || '_' || d AS location_name, 'region_' || g AS region, country_slug AS location_country,
    {cents('g * 1000 + d', 'DECIMAL(10,7)')} AS latitude, {cents('g * 2000 - d', 'DECIMAL(10,7)')} AS longitude,
    {_list(TIMEZONES)}[g + 1] AS timezone_id,
    CASE WHEN event_type = 'signup' THEN CAST(0 AS DECIMAL(10,2)) ELSE {cents('(3 * c + 23 * k) % 45000')} END AS co,
    CASE WHEN event_type = 'signup' THEN CAST(0 AS DECIMAL(10,2)) ELSE {cents('(11 * c + 19 * k) % 15000')} END AS no2,
    CASE WHEN event_type = 'signup' THEN CAST(0 AS DECIMAL(10,2)) ELSE {cents('(5 * c + 29 * k) % 20000')} END AS o3,
    CASE WHEN event_type = 'error' THEN NULL ELSE {cents('(13 * c + 31 * k) % 40000')} END AS pm10,
    CASE WHEN event_type = 'error' THEN NULL ELSE {cents('c % 30000')} END AS pm2_5,
    CASE WHEN event_type = 'signup' THEN CAST(0 AS DECIMAL(10,2)) ELSE {cents('(7 * c + 17 * k) % 15000')} END AS so2,
    CASE WHEN k % 50 = 0 THEN NULL ELSE 1 + k % 6 END AS us_epa_index,
    1 + c % 10 AS gb_defra_index,
    CAST({cents('(c + 3 * k) % 4000')} - 5 AS DECIMAL(10,2)) AS temp_c,
    {cents('(c + 5 * k) % 9000')} AS temp_f,
    (c + k) % 101 AS humidity, (7 * k) % 101 AS cloud_cover,
    {cents('(c + k) % 8000')} AS wind_kph, {cents('(c + 2 * k) % 5000')} AS wind_mph,
    (45 * k) % 360 AS wind_degree, {_list(WIND_DIRS)}[k % 8 + 1] AS wind_direction,
    {cents('99000 + c % 5000')} AS pressure_mb,
    CAST(CAST(k % 200 AS DECIMAL(18,0)) * 0.1 AS DECIMAL(10,2)) AS precip_mm,
    {cents('c % 1500')} AS visibility_km, k % 12 AS uv_index,
    event_type AS weather_condition, 1000 + k % 5 AS weather_condition_code,
    country_slug AS country, city_slug AS city, district_slug AS district,
    year(ts) AS year, month(ts) AS month, day(ts) AS day,
    'country=' || country_slug || '/city=' || city_slug || '/district=' || district_slug
      || '/year=' || lpad(CAST(year(ts) AS VARCHAR), 4, '0') || '/month=' || lpad(CAST(month(ts) AS VARCHAR), 2, '0')
      || '/day=' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || '/e_' || k || '.json' AS _stg_file_name,
    ts AS _stg_file_load_ts, md5(CAST(k AS VARCHAR)) AS _stg_file_md5, ts AS _copy_data_ts,
    '{COPY_USER}' AS _copy_data_user, '{COPY_ROLE}' AS _copy_data_role
  FROM src2
)"""
    clean = """
clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY measurement_epoch, location_name, latitude, longitude
      ORDER BY _stg_file_load_ts DESC NULLS FIRST, _copy_data_ts DESC NULLS FIRST, _stg_file_name DESC NULLS FIRST, _stg_file_md5 DESC NULLS FIRST) AS rn
    FROM flat) WHERE rn = 1
)"""
    keys = "hl, hu, country, city, district, location_name, region, latitude, longitude, timezone_id"
    hourly = f"""
hz AS (
  SELECT *, date_trunc('hour', timezone(timezone_id, measurement_ts AT TIME ZONE 'UTC')) AS hl,
         date_trunc('hour', measurement_ts) AS hu
  FROM clean
),
hm AS (
  SELECT *, count(*) OVER (PARTITION BY {keys}, wind_direction) AS wd_n,
            count(*) OVER (PARTITION BY {keys}, weather_condition) AS wc_n
  FROM hz
),
hagg AS (
  SELECT {keys},
    {rnd_dec('pm2_5', 2, 2)} AS pm2_5, {rnd_dec('pm10', 2, 2)} AS pm10, {rnd_dec('so2', 2, 2)} AS so2,
    {rnd_dec('no2', 2, 2)} AS no2, {rnd_dec('co', 2, 2)} AS co, {rnd_dec('o3', 2, 2)} AS o3,
    {rnd_dec('us_epa_index', 0, 0)} AS us_epa_index, {rnd_dec('gb_defra_index', 0, 0)} AS gb_defra_index,
    {rnd_dec('temp_c', 1, 2)} AS temp_c, {rnd_dec('humidity', 0, 0)} AS humidity,
    {rnd_dec('cloud_cover', 0, 0)} AS cloud_cover, {rnd_dec('wind_kph', 1, 2)} AS wind_kph,
    {mode_expr('wind_direction', 'wd_n')} AS wind_direction,
    {rnd_dec('pressure_mb', 1, 2)} AS pressure_mb, {rnd_dec('precip_mm', 2, 2)} AS precip_mm,
    {rnd_dec('visibility_km', 1, 2)} AS visibility_km, {rnd_dec('uv_index', 0, 0)} AS uv_index,
    {mode_expr('weather_condition', 'wc_n')} AS weather_condition,
    max(_stg_file_load_ts) AS _stg_file_load_ts, max(_copy_data_ts) AS _copy_data_ts,
    count(*) AS readings_in_hour
  FROM hm GROUP BY {keys}
),
hourly AS (
  SELECT hl AS hour_timestamp_local, hu AS hour_timestamp_utc,
    {fmt('country')} AS country, {fmt('city')} AS city, {fmt('district')} AS district,
    * EXCLUDE (hl, hu, country, city, district)
  FROM hagg
),
cons AS (
  SELECT hour_timestamp_local AS aqi_timestamp, year(hour_timestamp_local) AS aqi_year,
    month(hour_timestamp_local) AS aqi_month, quarter(hour_timestamp_local) AS aqi_quarter,
    day(hour_timestamp_local) AS aqi_day, hour(hour_timestamp_local) AS aqi_hour,
    dayofweek(hour_timestamp_local) AS aqi_day_of_week, strftime(hour_timestamp_local, '%a') AS aqi_day_name,
    hour_timestamp_utc AS aqi_timestamp_utc,
    country, city, district, location_name, region, latitude, longitude, timezone_id,
    pm2_5, pm10, so2, no2, co, o3, us_epa_index, gb_defra_index,
    temp_c, humidity, cloud_cover, wind_kph, wind_direction, pressure_mb, precip_mm, visibility_km, uv_index,
    weather_condition,
    {pm['prominent']} AS prominent_pollutant, {pm['criteria']} AS criteria_pollutant_count,
    {pm['custom_aqi']} AS custom_aqi,
    CASE us_epa_index WHEN 1 THEN 'Good' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Unhealthy for Sensitive Groups'
      WHEN 4 THEN 'Unhealthy' WHEN 5 THEN 'Very Unhealthy' WHEN 6 THEN 'Hazardous' ELSE 'Unknown' END AS epa_category,
    CASE WHEN gb_defra_index BETWEEN 1 AND 3 THEN 'Low' WHEN gb_defra_index BETWEEN 4 AND 6 THEN 'Moderate'
      WHEN gb_defra_index BETWEEN 7 AND 9 THEN 'High' WHEN gb_defra_index = 10 THEN 'Very High'
      ELSE 'Unknown' END AS defra_category,
    {pm['valid']} AS is_valid_measurement,
    readings_in_hour, _stg_file_load_ts, _copy_data_ts
  FROM hourly
)"""
    star = """
ddim AS (
  SELECT DISTINCT aqi_timestamp AS local_timestamp, aqi_year, aqi_month, aqi_quarter, aqi_day, aqi_hour,
         aqi_day_of_week, aqi_day_name FROM cons
),
ldim AS (
  SELECT DISTINCT latitude, longitude, country, city, district, location_name, region, timezone_id FROM cons
),
fact AS (
  SELECT aqi_timestamp AS local_timestamp, aqi_timestamp_utc AS utc_timestamp, aqi_hour, aqi_day_of_week,
    aqi_day_name, pm2_5, pm10, so2, no2, co, o3, us_epa_index, gb_defra_index, prominent_pollutant,
    criteria_pollutant_count, custom_aqi, temp_c, humidity, cloud_cover, wind_kph, wind_direction, pressure_mb,
    precip_mm, visibility_km, uv_index, is_valid_measurement, readings_in_hour, _stg_file_load_ts, _copy_data_ts,
    latitude AS f_lat, longitude AS f_lon
  FROM cons
),
fl AS (
  SELECT f.*, l.country AS l_country, l.city AS l_city, l.district AS l_district,
    l.location_name AS l_location_name, l.region AS l_region, l.latitude AS l_latitude,
    l.longitude AS l_longitude, l.timezone_id AS l_timezone_id
  FROM fact f JOIN ldim l ON f.f_lat IS NOT DISTINCT FROM l.latitude AND f.f_lon IS NOT DISTINCT FROM l.longitude
),
fld AS (
  SELECT fl.*, d.aqi_year AS d_year, d.aqi_month AS d_month, d.aqi_day AS d_day, d.aqi_hour AS d_hour,
    d.aqi_day_name AS d_day_name
  FROM fl JOIN ddim d ON fl.local_timestamp IS NOT DISTINCT FROM d.local_timestamp
)"""
    return {"flat": flat, "clean": clean, "hourly": hourly, "star": star}


LAYERS = ("flat", "clean", "hourly", "star")


def with_layers(upto: str, body: str, extra: str = "") -> str:
    ctes = _ctes()
    parts = [ctes[n] for n in LAYERS[: LAYERS.index(upto) + 1]]
    if extra:
        parts.append(extra)
    return "WITH " + ",".join(parts) + "\n" + body


def d(col: str, alias: str | None = None) -> str:
    return f"CAST({col} AS DOUBLE) AS {alias or col.split('.')[-1]}"


def b(col: str, alias: str | None = None) -> str:
    return f"CAST({col} AS BIGINT) AS {alias or col.split('.')[-1]}"


DEC_CLEAN = ("latitude", "longitude", "co", "no2", "o3", "pm10", "pm2_5", "so2", "temp_c", "temp_f", "wind_kph",
             "wind_mph", "pressure_mb", "precip_mm", "visibility_km")
INT_CLEAN = ("measurement_epoch", "request_epoch", "us_epa_index", "gb_defra_index", "humidity", "cloud_cover",
             "wind_degree", "uv_index", "weather_condition_code", "year", "month", "day")


def clean_select(src: str) -> str:
    from ..operators.clean import CLEAN_COLUMNS
    cols = []
    for c in CLEAN_COLUMNS:
        cols.append(d(c) if c in DEC_CLEAN else b(c) if c in INT_CLEAN else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


DEC_CONS = ("latitude", "longitude", "pm2_5", "pm10", "so2", "no2", "co", "o3", "us_epa_index", "gb_defra_index",
            "temp_c", "humidity", "cloud_cover", "wind_kph", "pressure_mb", "precip_mm", "visibility_km", "uv_index",
            "custom_aqi")
INT_CONS = ("aqi_year", "aqi_month", "aqi_quarter", "aqi_day", "aqi_hour", "aqi_day_of_week",
            "criteria_pollutant_count", "readings_in_hour")


def typed(cols, dec=DEC_CONS, ints=INT_CONS, prefix: str = "") -> str:
    out = []
    for c in cols:
        src = f"{prefix}{c}"
        out.append(d(src, c) if c in dec else b(src, c) if c in ints else f"{src} AS {c}")
    return ", ".join(out)
