"""Anomaly detection of observations against their location's monthly
profile (the speed layer checked by the batch layer).

The profile lookup is an equi-join on (country, city, month).  The baseline
side has at most 12 rows per location; the join is left outer so that
observations without a profile are kept (and are never anomalies).  Spark
picks a broadcast hash join when the baseline's measured size is under the
broadcast threshold (adaptive execution re-plans with the real size) and a
shuffle join beyond it, so no hint is forced on a side whose size is not
known up front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.operators.joins import shared_table

LOCATION = ("country", "city")
SIGMA_FACTOR = 2.0

ANOMALY_COLUMNS = ["is_anomaly", "anomaly_type", "variable", "observed_value",
                   "expected_value", "deviation", "threshold"]


def baseline(profile: DataFrame, keys=LOCATION, digits: int | None = None) -> DataFrame:
    """(location, month) -> expected temperature/wind and their std-devs.

    ``digits=2`` reproduces a baseline read back from rounded documents.
    """
    def r(c):
        return F.round(F.col(c), digits) if digits is not None else F.col(c)
    return profile.select(*keys, "month",
                          r("temp_mean").alias("base_temp_mean"),
                          r("temp_stddev").alias("base_temp_stddev"),
                          r("wind_mean").alias("base_wind_mean"),
                          r("wind_stddev").alias("base_wind_stddev"))


def baseline_from_documents(docs: DataFrame, keys=LOCATION) -> DataFrame:
    """Baseline from profile documents (``profiles`` array of month structs
    with ``temperature`` / ``wind`` mean and stddev), e.g. documents read
    back with ``sources.files.read_json_documents``."""
    months = docs.select(*keys, F.explode("profiles").alias("p"))
    return months.select(*keys, F.col("p.month").cast("int").alias("month"),
                         F.col("p.temperature.mean").alias("base_temp_mean"),
                         F.col("p.temperature.stddev").alias("base_temp_stddev"),
                         F.col("p.wind.mean").alias("base_wind_mean"),
                         F.col("p.wind.stddev").alias("base_wind_stddev"))


def anomaly_columns(temp: Column, wind: Column, t_mean: Column, t_sd: Column,
                    w_mean: Column, w_sd: Column, k: float = SIGMA_FACTOR) -> dict:
    """Temperature is tested first (heat_wave / cold_wave); wind (wind_storm)
    only when the temperature is normal.  Strictly more than ``k`` standard
    deviations; any null input means "not anomalous"."""
    t_dev, w_dev = F.abs(temp - t_mean), F.abs(wind - w_mean)
    t_thr, w_thr = t_sd * k, w_sd * k
    t_out = F.coalesce(t_dev > t_thr, F.lit(False))
    w_out = F.coalesce(w_dev > w_thr, F.lit(False))

    def pick(t_val, w_val):
        return F.when(t_out, t_val).when(w_out, w_val)

    return {
        "is_anomaly": t_out | w_out,
        "anomaly_type": pick(F.when(temp > t_mean, "heat_wave").otherwise("cold_wave"),
                             F.lit("wind_storm")),
        "variable": pick(F.lit("temperature"), F.lit("windspeed")),
        "observed_value": pick(temp, wind),
        "expected_value": pick(t_mean, w_mean),
        "deviation": pick(t_dev, w_dev),
        "threshold": pick(t_thr, w_thr),
    }


def detect_anomalies(observations: DataFrame, base: DataFrame, ts_col: str = "event_time",
                     keys=LOCATION, k: float = SIGMA_FACTOR,
                     only_anomalies: bool = True) -> DataFrame:
    """Observations tagged with the anomaly fields (M11 columns)."""
    obs = observations.select(F.col(ts_col).alias("event_timestamp"), *keys,
                              F.month(F.col(ts_col)).alias("month"),
                              "temperature", "windspeed")
    joined = obs.join(base, [*keys, "month"], "left")
    return _tag(joined, keys, k, only_anomalies)


def detect_anomalies_checked(observations: DataFrame, base: DataFrame,
                             ts_col: str = "event_time", keys=LOCATION,
                             k: float = SIGMA_FACTOR, only_anomalies: bool = True) -> DataFrame:
    """``detect_anomalies`` with the baseline (12 rows per location) written
    once to the shared folder, so that Spark plans the lookup by its size:
    broadcast under the threshold, beyond it a shuffle join."""
    return detect_anomalies(observations, shared_table(base, "baseline"), ts_col, keys, k, only_anomalies)


def _tag(joined: DataFrame, keys, k, only_anomalies) -> DataFrame:
    cols = anomaly_columns(F.col("temperature"), F.col("windspeed"),
                           F.col("base_temp_mean"), F.col("base_temp_stddev"),
                           F.col("base_wind_mean"), F.col("base_wind_stddev"), k)
    out = joined.select("event_timestamp", *keys, "month", "temperature", "windspeed",
                        *[cols[c].alias(c) for c in ANOMALY_COLUMNS])
    return out.filter("is_anomaly") if only_anomalies else out


# Unit shown per variable in the anomaly read-out.
UNITS = {"temperature": "°C", "windspeed": "m/s"}


def anomaly_feed(anomalies: DataFrame) -> DataFrame:
    """Read-out fields: formatted time, readable type, unit, percent gap."""
    return anomalies.select(
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time_text"),
        *LOCATION,
        F.upper(F.regexp_replace("anomaly_type", "_", " ")).alias("anomaly_label"),
        "variable",
        F.when(F.col("variable") == "temperature", UNITS["temperature"])
        .otherwise(UNITS["windspeed"]).alias("unit"),
        "observed_value", "expected_value", "deviation", "threshold",
        (F.try_divide(F.col("observed_value") - F.col("expected_value"),
                      F.col("expected_value")) * 100).alias("pct_deviation"))
