"""Alert-level classification (three-band thresholds).

A value below ``low`` is level 0, ``low..high`` inclusive is level 1, above
``high`` is level 2.  Missing values give ``"unknown"`` for the string levels
of the speed layer and 0 for the numeric levels of the daily profiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions._col import as_col

# Thresholds of the alert scheme (m/s and degrees C).
WIND_BOUNDS = (10.0, 20.0)
HEAT_BOUNDS = (25.0, 35.0)

LEVELS = ("level_0", "level_1", "level_2")
UNKNOWN_LEVEL = "unknown"


def level_of(c, low: float, high: float, unknown: str = UNKNOWN_LEVEL) -> Column:
    c = as_col(c)
    return (F.when(c < low, LEVELS[0])
            .when(c <= high, LEVELS[1])
            .when(c > high, LEVELS[2])
            .otherwise(unknown))


def numeric_level_of(c, low: float, high: float, missing: int = 0) -> Column:
    c = as_col(c)
    return (F.when(c < low, 0)
            .when(c <= high, 1)
            .when(c > high, 2)
            .otherwise(missing))


def wind_level(c="windspeed", bounds=WIND_BOUNDS) -> Column:
    return level_of(c, *bounds)


def heat_level(c="temperature", bounds=HEAT_BOUNDS) -> Column:
    return level_of(c, *bounds)


def wind_level_num(c="windspeed_max", bounds=WIND_BOUNDS) -> Column:
    return numeric_level_of(c, *bounds)


def heat_level_num(c="temp_mean", bounds=HEAT_BOUNDS) -> Column:
    return numeric_level_of(c, *bounds)


def critical_flag(wind="wind_alert_level", heat="heat_alert_level") -> Column:
    """True when either level is ``level_2`` (null levels count as not critical)."""
    return F.coalesce((as_col(wind) == LEVELS[2]) | (as_col(heat) == LEVELS[2]),
                      F.lit(False))


def any_alert(wind="wind_alert_level", heat="heat_alert_level") -> Column:
    """Either level is 1 or 2 (the critical-window pre-filter)."""
    raised = list(LEVELS[1:])
    return F.coalesce(as_col(wind).isin(raised) | as_col(heat).isin(raised), F.lit(False))


def with_alert_levels(df: DataFrame, wind_col: str = "windspeed",
                      temp_col: str = "temperature",
                      wind_bounds=WIND_BOUNDS, heat_bounds=HEAT_BOUNDS) -> DataFrame:
    return (df.withColumn("wind_alert_level", level_of(wind_col, *wind_bounds))
              .withColumn("heat_alert_level", level_of(temp_col, *heat_bounds)))
