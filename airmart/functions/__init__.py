"""Column expressions: the reference's UDFs and scalar helpers, all JVM-side."""

from .agg import mode_of, round_avg
from .keys import surrogate_key
from .metrics import (aqi_band, aqi_criteria_met, custom_aqi, defra_category, epa_category,
                      freshness_status, is_valid_measurement, prominent_pollutant)
from .names import LOWERCASE_WORDS, format_location_name
from .timefn import (boundary_diff, day_name, day_of_week0, hour_floor, hour_label, local_hour,
                     minute_floor, ntz_from_epoch, to_local)

__all__ = [
    "mode_of", "round_avg", "surrogate_key", "aqi_band", "aqi_criteria_met", "custom_aqi",
    "defra_category", "epa_category", "freshness_status", "is_valid_measurement",
    "prominent_pollutant", "LOWERCASE_WORDS", "format_location_name", "boundary_diff", "day_name",
    "day_of_week0", "hour_floor", "hour_label", "local_hour", "minute_floor", "ntz_from_epoch",
    "to_local",
]
