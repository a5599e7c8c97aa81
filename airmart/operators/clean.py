"""Clean layer: JSON flattening (P-1), presence filter (P-2) and latest-file-wins dedup (W-1).

Plan shape: one projection of 32 ``variant_get`` paths over the parsed
document, then a single shuffle on the four dedup keys. ``row_number() == 1``
is planned with a *partial* WindowGroupLimit before the exchange, so every map
task keeps one row per key and a key that holds a third of all rows does not
land whole in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import ntz_from_epoch

# (output column, JSON path, target type). ``::NUMBER`` without scale rounds, so
# integers are read as decimal(38,0) and then narrowed (variant_get(.., 'int')
# would truncate 3.7 to 3).
_NUM = "decimal(38,0)"
PAYLOAD_FIELDS = (
    ("measurement_epoch", "$.current.last_updated_epoch", _NUM, "bigint"),
    ("request_epoch", "$.location.localtime_epoch", _NUM, "bigint"),
    ("location_name", "$.location.name", "string", None),
    ("region", "$.location.region", "string", None),
    ("location_country", "$.location.country", "string", None),
    ("latitude", "$.location.lat", "decimal(10,7)", None),
    ("longitude", "$.location.lon", "decimal(10,7)", None),
    ("timezone_id", "$.location.tz_id", "string", None),
    ("co", "$.current.air_quality.co", "decimal(10,2)", None),
    ("no2", "$.current.air_quality.no2", "decimal(10,2)", None),
    ("o3", "$.current.air_quality.o3", "decimal(10,2)", None),
    ("pm10", "$.current.air_quality.pm10", "decimal(10,2)", None),
    ("pm2_5", "$.current.air_quality.pm2_5", "decimal(10,2)", None),
    ("so2", "$.current.air_quality.so2", "decimal(10,2)", None),
    ("us_epa_index", '$.current.air_quality["us-epa-index"]', _NUM, "int"),
    ("gb_defra_index", '$.current.air_quality["gb-defra-index"]', _NUM, "int"),
    ("temp_c", "$.current.temp_c", "decimal(10,2)", None),
    ("temp_f", "$.current.temp_f", "decimal(10,2)", None),
    ("humidity", "$.current.humidity", _NUM, "int"),
    ("cloud_cover", "$.current.cloud", _NUM, "int"),
    ("wind_kph", "$.current.wind_kph", "decimal(10,2)", None),
    ("wind_mph", "$.current.wind_mph", "decimal(10,2)", None),
    ("wind_degree", "$.current.wind_degree", _NUM, "int"),
    ("wind_direction", "$.current.wind_dir", "string", None),
    ("pressure_mb", "$.current.pressure_mb", "decimal(10,2)", None),
    ("precip_mm", "$.current.precip_mm", "decimal(10,2)", None),
    ("visibility_km", "$.current.vis_km", "decimal(10,2)", None),
    ("uv_index", "$.current.uv", _NUM, "int"),
    ("weather_condition", "$.current.condition.text", "string", None),
    ("weather_condition_code", "$.current.condition.code", _NUM, "int"),
)

PARTITION_COLS = ("country", "city", "district", "year", "month", "day")
AUDIT_COLS = ("_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts",
              "_copy_data_user", "_copy_data_role")
DEDUP_KEYS = ("measurement_epoch", "location_name", "latitude", "longitude")
ORDER_COLUMNS = ("_stg_file_load_ts", "_copy_data_ts", "_stg_file_name", "_stg_file_md5")

CLEAN_COLUMNS = (
    "measurement_ts", "measurement_epoch", "request_ts", "request_epoch", "location_name", "region",
    "location_country", "latitude", "longitude", "timezone_id", "co", "no2", "o3", "pm10", "pm2_5",
    "so2", "us_epa_index", "gb_defra_index", "temp_c", "temp_f", "humidity", "cloud_cover", "wind_kph",
    "wind_mph", "wind_degree", "wind_direction", "pressure_mb", "precip_mm", "visibility_km", "uv_index",
    "weather_condition", "weather_condition_code", *PARTITION_COLS, *AUDIT_COLS,
)


def _get(v: Column, path: str, typ: str, narrow: str | None, lenient: bool) -> Column:
    fn = F.try_variant_get if lenient else F.variant_get
    x = fn(v, path, typ)
    return x.cast(narrow) if narrow else x


def has_path(v: Column, path: str) -> Column:
    """P-2: the path exists; a JSON ``null`` counts as present (D9)."""
    return F.variant_get(v, path, "variant").isNotNull()


def flatten_payload(raw: DataFrame, lenient: bool = False, keep: tuple = ()) -> DataFrame:
    """P-1 + P-2: typed clean-layer columns from the VARIANT document.

    Strict by default: a present but uncastable value fails the query, as the
    reference's hard casts do. ``lenient=True`` yields NULL instead (used by
    the quarantine split, Q-14). ``keep`` names further columns to pass on.
    """
    v = F.col("raw")
    fields = {name: _get(v, path, typ, narrow, lenient) for name, path, typ, narrow in PAYLOAD_FIELDS}
    cols = [
        ntz_from_epoch(fields["measurement_epoch"]).alias("measurement_ts"),
        fields["measurement_epoch"].alias("measurement_epoch"),
        ntz_from_epoch(fields["request_epoch"]).alias("request_ts"),
    ]
    cols += [fields[n].alias(n) for n in CLEAN_COLUMNS[3:32]]
    cols += [F.col(c) for c in (*PARTITION_COLS, *AUDIT_COLS, *keep)]
    return raw.where(has_path(v, "$.current.last_updated")).select(*cols)


def latest_file_order() -> list[Column]:
    """D8: load time descending with NULLs first, then deterministic tie-breakers.

    Copy time and file name break ties between files; the content hash breaks
    ties between readings of one JSON Lines file (same name and load time).
    """
    return [F.col(c).desc_nulls_first() for c in ORDER_COLUMNS]


def dedup_latest_file(flat: DataFrame) -> DataFrame:
    """W-1: one row per (epoch, name, lat, lon), the latest loaded file wins."""
    w = Window.partitionBy(*DEDUP_KEYS).orderBy(*latest_file_order())
    return (flat.withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") == 1)
            .select(*CLEAN_COLUMNS))


def clean(raw: DataFrame) -> DataFrame:
    """``clean_aqi_dt``: flatten, filter, dedup."""
    return dedup_latest_file(flatten_payload(raw))
