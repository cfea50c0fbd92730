"""Optional unit normalisation driven by the message's ``units`` object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Factors to metres per second.
WIND_TO_MS = {"m/s": 1.0, "km/h": 1 / 3.6, "mp/h": 0.44704, "kn": 0.514444}


def normalise_wind(df: DataFrame, wind_col: str = "windspeed", units_col: str = "units",
                   unit_key: str = "wind_speed_10m") -> DataFrame:
    """Convert ``wind_col`` to m/s using ``units[unit_key]``; rows without a
    known unit are left unchanged."""
    unit = F.try_element_at(F.col(units_col), F.lit(unit_key))
    factor = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in WIND_TO_MS.items() for x in kv]), unit)
    return df.withColumn(wind_col, F.col(wind_col) * F.coalesce(factor, F.lit(1.0)))
