"""Record shapes used across the package (all fields nullable)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType,
                               IntegerType, LongType, MapType, StringType,
                               StructField, StructType, TimestampType)


_TYPES = {"string": StringType(), "double": DoubleType(), "int": IntegerType(),
          "bigint": LongType(), "boolean": BooleanType(), "timestamp": TimestampType(),
          "date": DateType(), "binary": None}


def _type(name: str):
    if name.startswith("array<") and name.endswith(">"):
        return ArrayType(_type(name[6:-1]))
    if name == "binary":
        from pyspark.sql.types import BinaryType
        return BinaryType()
    return _TYPES[name]


def _fields(spec: str) -> StructType:
    """Shorthand for flat schemas: ``"a string, b double"`` (all nullable)."""
    return StructType([StructField(n, _type(t))
                       for n, t in (f.strip().split(" ", 1) for f in spec.split(","))])


# Flat observation message sent by the producers (M2): 13 scalars + units.
FLAT_OBSERVATION = StructType([
    StructField("timestamp", StringType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("country_code", StringType()),
    StructField("region", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("temperature", DoubleType()),
    StructField("windspeed", DoubleType()),
    StructField("wind_direction", DoubleType()),
    StructField("weather_code", IntegerType()),
    StructField("humidity", DoubleType()),
    StructField("precipitation", DoubleType()),
    StructField("units", MapType(StringType(), StringType())),
])

# Observation fields read by the speed layer (M3).
OBSERVATION = StructType([f for f in FLAT_OBSERVATION.fields
                          if f.name not in ("country_code", "region", "units")])

# Current-weather block of a nested observation payload (M1).
CURRENT_BLOCK = _fields(
    "temperature_2m double, relative_humidity_2m double, precipitation double, "
    "weather_code int, wind_speed_10m double, wind_direction_10m double")

NESTED_OBSERVATION = StructType([
    StructField("timestamp", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("city", StringType()),
    StructField("weather_data", StructType([
        StructField("current", CURRENT_BLOCK),
        StructField("current_units", MapType(StringType(), StringType())),
    ])),
])

# Classified observation (M4, topic weather_transformed).  country_code,
# region and units are carried through instead of being dropped.
CLASSIFIED_OBSERVATION = StructType(_fields(
    "event_time string, original_timestamp string, city string, country string, "
    "country_code string, region string, "
    "latitude double, longitude double, temperature double, windspeed double, "
    "wind_direction double, weather_code int, humidity double, precipitation double, "
    "wind_alert_level string, heat_alert_level string, processed_at string").fields
    + [StructField("units", MapType(StringType(), StringType()))])

# Stored alert (M5, JSON Lines under {country}/{city}/alerts.json).
STORED_ALERT = _fields(
    "event_time string, city string, country string, country_code string, "
    "temperature double, windspeed double, wind_alert_level string, "
    "heat_alert_level string, weather_code int, humidity double, precipitation double")

# Daily history record (M6).  ``date`` arrives as a string and is cast.
DAILY_RAW = _fields(
    "date string, city string, country string, latitude double, longitude double, "
    "temp_max double, temp_min double, temp_mean double, precipitation double, "
    "rain double, snowfall double, windspeed_max double, windgusts_max double, "
    "weather_code int")

# Archive payload: parallel arrays under ``daily`` (M7).
ARCHIVE_PAYLOAD = StructType([
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("daily", _fields(
        "time array<string>, temperature_2m_max array<double>, "
        "temperature_2m_min array<double>, temperature_2m_mean array<double>, "
        "precipitation_sum array<double>, rain_sum array<double>, "
        "snowfall_sum array<double>, windspeed_10m_max array<double>, "
        "windgusts_10m_max array<double>, weathercode array<int>")),
])

# Geocoding candidates (M12).
LOCATION_CANDIDATE = _fields(
    "name string, country string, country_code string, latitude double, "
    "longitude double, admin1 string, population bigint")

GEOCODING_PAYLOAD = StructType([
    StructField("query_name", StringType()),
    StructField("query_country", StringType()),
    StructField("results", ArrayType(LOCATION_CANDIDATE)),
])

# Anomaly event (M11, topic weather_anomalies).
ANOMALY_EVENT = StructType([
    StructField("event_timestamp", TimestampType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("month", IntegerType()),
    StructField("temperature", DoubleType()),
    StructField("windspeed", DoubleType()),
    StructField("is_anomaly", BooleanType()),
    StructField("anomaly_type", StringType()),
    StructField("variable", StringType()),
    StructField("observed_value", DoubleType()),
    StructField("expected_value", DoubleType()),
    StructField("deviation", DoubleType()),
    StructField("threshold", DoubleType()),
])

# Kafka record envelope (M14) as exposed by Spark's Kafka source.
KAFKA_ENVELOPE = _fields(
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int")

__all__ = [name for name in dir() if name.isupper()]
