"""Column-expression helpers (all JVM-side, codegen friendly)."""

from squall.functions.classify import (critical_flag, heat_level, heat_level_num,
                                       level_of, numeric_level_of, wind_level,
                                       wind_level_num, with_alert_levels)
from squall.functions.labels import month_name_fr, weather_label
from squall.functions.names import location_key, safe_name, split_location_key
from squall.functions.parsing import (parse_json_column, tolerant_timestamp,
                                      to_date_safe, to_json_value, with_defaults)

__all__ = [
    "critical_flag", "heat_level", "heat_level_num", "level_of", "numeric_level_of",
    "wind_level", "wind_level_num", "with_alert_levels", "month_name_fr",
    "weather_label", "location_key", "safe_name", "split_location_key",
    "parse_json_column", "tolerant_timestamp", "to_date_safe", "to_json_value",
    "with_defaults",
]
