"""Batch-layer queries over the ``daily`` view (records, rolling sums,
profiles, validation) and the anomaly check of ``obs`` against profiles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from squall.functions.classify import heat_level_num
from squall.functions.rounding import exact_mean, exact_share, sql_rounded_ratio
from squall.operators import anomalies as A
from squall.operators import profiles as P
from squall.operators import records as R
from squall.operators.joins import materialize
from squall.plans.registry import ORACLES, register
from squall.plans.sqlviews import MONTH_NAME, ctes, with_views
from squall.session import scratch_path
from squall.sinks.files import swap_documents
from squall.sources.files import read_json_documents
from squall.sources.testviews import daily, obs


def _top1(src: str, measure: str, cols: str, desc: bool = True) -> str:
    order = f"{measure} DESC" if desc else f"{measure} ASC"
    return (f"SELECT country, city, {cols} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY country, city ORDER BY {order}, date) AS rn FROM {src} "
            f"WHERE {measure} IS NOT NULL) WHERE rn = 1")


RECORDS_SQL = with_views(ctes("daily", extra=[
    "r AS (SELECT *, sum(precipitation) OVER (PARTITION BY country, city ORDER BY date "
    "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rain_30days FROM daily)",
    "hot AS (" + _top1("r", "temp_max", "date AS hottest_date, temp_max AS hottest_temp_max, "
                       "temp_min AS hottest_temp_min") + ")",
    "cold AS (" + _top1("r", "temp_min", "date AS coldest_date, temp_max AS coldest_temp_max, "
                        "temp_min AS coldest_temp_min", desc=False) + ")",
    "wind AS (" + _top1("r", "windgusts_max", "date AS windiest_date, windgusts_max AS "
                        "windiest_gust, windspeed_max AS windiest_speed") + ")",
    "rain AS (" + _top1("r", "rain_30days", "date AS rainiest_date, rain_30days") + ")",
    "snow AS (" + _top1("r", "snowfall", "date AS snowiest_date, snowfall") + ")",
    "st AS (SELECT country, city, max(temp_max) AS absolute_max_temp, min(temp_min) AS "
    "absolute_min_temp, max(windgusts_max) AS absolute_max_wind, sum(precipitation) AS "
    "total_precipitation, sum(snowfall) AS total_snowfall, count(*) AS total_days "
    "FROM daily GROUP BY country, city)"]), """
SELECT st.country, st.city, hottest_date, hottest_temp_max, hottest_temp_min,
       coldest_date, coldest_temp_max, coldest_temp_min,
       windiest_date, windiest_gust, windiest_speed, rainiest_date, rain_30days,
       snowiest_date, snowfall, absolute_max_temp, absolute_min_temp, absolute_max_wind,
       total_precipitation, total_snowfall, total_days
FROM st
LEFT JOIN hot ON hot.country = st.country AND hot.city = st.city
LEFT JOIN cold ON cold.country = st.country AND cold.city = st.city
LEFT JOIN wind ON wind.country = st.country AND wind.city = st.city
LEFT JOIN rain ON rain.country = st.country AND rain.city = st.city
LEFT JOIN snow ON snow.country = st.country AND snow.city = st.city""")


@register("records_by_city", RECORDS_SQL)
def records_by_city(spark, sf_dir):
    """Climate records per location: extreme days, wettest 30-row period, totals."""
    return R.climate_records(daily(spark, sf_dir))


def _num_sql(c: str) -> str:
    return "regexp_replace(CAST(CAST(" + c + " AS DECIMAL(38,6)) AS VARCHAR), '0{1,5}$', '')"


# The description texts.
RECORDS_DOCUMENT_SQL = f"""
SELECT country, city, CAST(hottest_date AS VARCHAR) AS hottest_day_date,
       hottest_temp_max AS hottest_day_temp_max, hottest_temp_min AS hottest_day_temp_min,
       'Jour le plus chaud: ' || {_num_sql("hottest_temp_max")} || '°C' AS hottest_day_description,
       CAST(coldest_date AS VARCHAR) AS coldest_day_date,
       coldest_temp_max AS coldest_day_temp_max, coldest_temp_min AS coldest_day_temp_min,
       'Jour le plus froid: ' || {_num_sql("coldest_temp_min")} || '°C' AS coldest_day_description,
       CAST(windiest_date AS VARCHAR) AS windiest_day_date,
       windiest_gust AS windiest_day_windgusts_max, windiest_speed AS windiest_day_windspeed_max,
       'Rafale la plus forte: ' || {_num_sql("windiest_gust")} || ' m/s' AS windiest_day_description,
       CAST(rainiest_date AS VARCHAR) AS rainiest_period_date,
       rain_30days AS rainiest_period_rain_30days,
       CASE WHEN rain_30days IS NOT NULL THEN
         printf('Période la plus pluvieuse (30 jours): %.1f mm', rain_30days) END
         AS rainiest_period_description,
       CAST(snowiest_date AS VARCHAR) AS snowiest_day_date, snowfall AS snowiest_day_snowfall,
       'Jour le plus neigeux: ' || {_num_sql("snowfall")} || ' cm' AS snowiest_day_description,
       absolute_max_temp AS statistics_absolute_max_temp,
       absolute_min_temp AS statistics_absolute_min_temp,
       absolute_max_wind AS statistics_absolute_max_wind,
       total_precipitation AS statistics_total_precipitation,
       total_snowfall AS statistics_total_snowfall, total_days AS statistics_total_days
FROM ({RECORDS_SQL})"""


@register("records_document", RECORDS_DOCUMENT_SQL)
def records_document(spark, sf_dir):
    """Records documents (one per location), their nested fields laid flat."""
    docs = R.records_document(R.climate_records(daily(spark, sf_dir)))
    parts = [f for f in docs.schema.fields if f.name not in ("country", "city")]
    return docs.select("country", "city", *[F.col(f"{p.name}.{c}").alias(f"{p.name}_{c}")
                                            for p in parts for c in p.dataType.names])


@register("rolling_30", with_views(ctes("daily"), """
SELECT country, city, date, precipitation,
       sum(precipitation) OVER (PARTITION BY country, city ORDER BY date
                                ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rain_30days
FROM daily"""))
def rolling_30(spark, sf_dir):
    """Precipitation summed over the last 30 rows of each location's history."""
    return (R.rolling_sum(daily(spark, sf_dir), "precipitation", 30, "rain_30days")
            .select("country", "city", "date", "precipitation", "rain_30days"))


@register("rolling_30_days", with_views(ctes("daily"), """
SELECT country, city, date, precipitation,
       sum(precipitation) OVER (PARTITION BY country, city ORDER BY date
            RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS rain_30days
FROM daily"""))
def rolling_30_days(spark, sf_dir):
    """Precipitation summed over the last 30 calendar days (gaps respected)."""
    return (R.rolling_sum(daily(spark, sf_dir), "precipitation", 30, "rain_30days",
                          mode="range")
            .select("country", "city", "date", "precipitation", "rain_30days"))


_LVL_T = ("(CASE WHEN temp_mean < 25 THEN 0 WHEN temp_mean <= 35 THEN 1 "
          "WHEN temp_mean > 35 THEN 2 ELSE 0 END)")
_LVL_W = ("(CASE WHEN windspeed_max < 10 THEN 0 WHEN windspeed_max <= 20 THEN 1 "
          "WHEN windspeed_max > 20 THEN 2 ELSE 0 END)")

PROFILE_CTE = f"""prof AS (
  SELECT country, city, CAST(month(date) AS INTEGER) AS month,
         avg(temp_mean) AS temp_mean, avg(temp_max) AS temp_max, avg(temp_min) AS temp_min,
         stddev_samp(temp_mean) AS temp_stddev, min(temp_min) AS temp_abs_min,
         max(temp_max) AS temp_abs_max, avg(windspeed_max) AS wind_mean,
         avg(windgusts_max) AS windgust_mean, stddev_samp(windspeed_max) AS wind_stddev,
         max(windgusts_max) AS wind_abs_max, avg(precipitation) AS precipitation_mean,
         avg(rain) AS rain_mean, avg(snowfall) AS snowfall_mean,
         count(CASE WHEN {_LVL_T} >= 1 THEN 1 END) / count(*) AS heat_alert_probability,
         count(CASE WHEN {_LVL_W} >= 1 THEN 1 END) / count(*) AS wind_alert_probability,
         count(*) AS days_count
  FROM daily GROUP BY country, city, CAST(month(date) AS INTEGER))"""


@register("seasonal_profile", with_views(ctes("daily", extra=[PROFILE_CTE]),
                                          "SELECT * FROM prof"))
def seasonal_profile(spark, sf_dir):
    """Basic monthly profile per location (means, std-devs, extremes, alert shares)."""
    return P.seasonal_profile(daily(spark, sf_dir))


def _best_month(measure: str, out: str, desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    return (f"{out} AS (SELECT country, city, month_name AS {out} FROM (SELECT *, row_number() "
            f"OVER (PARTITION BY country, city ORDER BY {measure} {order}, month) AS rn "
            f"FROM pm WHERE {measure} IS NOT NULL) WHERE rn = 1)")


@register("annual_summary", with_views(ctes("daily", extra=[
    PROFILE_CTE, f"pm AS (SELECT *, {MONTH_NAME} AS month_name FROM prof)",
    _best_month("temp_mean", "hottest_month", True),
    _best_month("temp_mean", "coldest_month", False),
    _best_month("wind_mean", "windiest_month", True),
    "agg AS (SELECT country, city, avg(temp_mean) AS annual_temp_mean, avg(wind_mean) AS "
    "annual_wind_mean, max(temp_mean) AS hottest_month_temp, min(temp_mean) AS "
    "coldest_month_temp, max(wind_mean) AS windiest_month_wind, count(*) AS months "
    "FROM prof GROUP BY country, city)"]), """
SELECT agg.*, h.hottest_month, c.coldest_month, w.windiest_month
FROM agg
LEFT JOIN hottest_month h ON h.country = agg.country AND h.city = agg.city
LEFT JOIN coldest_month c ON c.country = agg.country AND c.city = agg.city
LEFT JOIN windiest_month w ON w.country = agg.country AND w.city = agg.city"""))
def annual_summary(spark, sf_dir):
    """Annual means and hottest / coldest / windiest month per location."""
    return P.annual_summary(P.seasonal_profile(daily(spark, sf_dir)))


ENRICHED_CTE = """eprof AS (
  SELECT country, city, CAST(month(date) AS INTEGER) AS month,
         avg(temp_mean) AS temp_mean, avg(temp_max) AS temp_max, avg(temp_min) AS temp_min,
         stddev_samp(temp_mean) AS temp_stddev, min(temp_min) AS temp_abs_min,
         max(temp_max) AS temp_abs_max,
         quantile_disc(temp_mean, 0.5) AS temp_median,
         quantile_disc(temp_mean, 0.25) AS temp_q25,
         quantile_disc(temp_mean, 0.75) AS temp_q75,
         avg(windspeed_max) AS wind_mean, avg(windgusts_max) AS windgust_mean,
         stddev_samp(windspeed_max) AS wind_stddev, min(windspeed_max) AS wind_abs_min,
         max(windgusts_max) AS wind_abs_max,
         quantile_disc(windspeed_max, 0.5) AS wind_median,
         quantile_disc(windspeed_max, 0.25) AS wind_q25,
         quantile_disc(windspeed_max, 0.75) AS wind_q75,
         avg(precipitation) AS precipitation_mean,
         stddev_samp(precipitation) AS precipitation_stddev,
         max(precipitation) AS precipitation_max, count(*) AS days_count
  FROM daily GROUP BY country, city, CAST(month(date) AS INTEGER))"""


@register("enriched_profile", with_views(ctes("daily", extra=[ENRICHED_CTE]), """
SELECT *, temp_q75 - temp_q25 AS temp_iqr, wind_q75 - wind_q25 AS wind_iqr FROM eprof"""))
def enriched_profile(spark, sf_dir):
    """Monthly profile with medians, quartiles, IQR and precipitation spread."""
    return P.enriched_profile(daily(spark, sf_dir))


def _quality_cte(t_hi: int, w_hi: int) -> str:
    return f"""mq AS (
  SELECT country, city, CAST(month(date) AS INTEGER) AS month,
         count(CASE WHEN temp_mean IS NULL THEN 1 END) AS null_temp,
         count(CASE WHEN windspeed_max IS NULL THEN 1 END) AS null_wind,
         count(CASE WHEN temp_mean < -50 OR temp_mean > {t_hi} OR windspeed_max < 0
                         OR windspeed_max > {w_hi} THEN 1 END) AS unrealistic,
         count(*) AS days_count
  FROM daily GROUP BY country, city, CAST(month(date) AS INTEGER))"""


def _validation_sql(t_hi: int, w_hi: int) -> str:
    return with_views(ctes("daily", extra=[
        _quality_cte(t_hi, w_hi),
        "w AS (SELECT country, city, month, 0 AS k, 'Mois ' || month || ': ' || null_temp || "
        "' valeurs de température manquantes' AS msg FROM mq WHERE null_temp > 0 "
        "UNION ALL SELECT country, city, month, 1 AS k, 'Mois ' || month || ': ' || null_wind || "
        "' valeurs de vent manquantes' AS msg FROM mq WHERE null_wind > 0)",
        "wl AS (SELECT country, city, string_agg(msg, ' | ' ORDER BY month, k) AS wtxt, "
        "count(*) AS nw FROM w GROUP BY country, city)",
        "per AS (SELECT country, city, count(DISTINCT month) AS months_present, "
        "CAST(sum(unrealistic) AS BIGINT) AS unrealistic_count FROM mq GROUP BY country, city)"]),
        """
SELECT per.country, per.city, months_present, unrealistic_count,
       months_present >= 12 AS is_valid,
       CAST(CASE WHEN months_present < 12 THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
       CAST(coalesce(nw, 0) + CASE WHEN unrealistic_count > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_warnings,
       CASE WHEN months_present < 12
            THEN 'Profil incomplet: seulement ' || months_present || '/12 mois présents'
            ELSE '' END AS errors_text,
       concat_ws(' | ', CASE WHEN wtxt <> '' THEN wtxt END,
                 CASE WHEN unrealistic_count > 0
                      THEN unrealistic_count || ' valeurs non réalistes détectées' END)
         AS warnings_text
FROM per LEFT JOIN wl ON wl.country = per.country AND wl.city = per.city""")


def _validation_report(df):
    return df.select("country", "city", "months_present", "unrealistic_count", "is_valid",
                     F.size("errors").cast("bigint").alias("n_errors"),
                     F.size("warnings").cast("bigint").alias("n_warnings"),
                     F.array_join("errors", " | ").alias("errors_text"),
                     F.array_join("warnings", " | ").alias("warnings_text"))


@register("profile_validation", _validation_sql(60, 60))
def profile_validation(spark, sf_dir):
    """Validation report per location (12 months, missing and implausible values)."""
    return _validation_report(P.validate_profile(daily(spark, sf_dir)))


@register("profile_validation_strict", _validation_sql(50, 45))
def profile_validation_strict(spark, sf_dir):
    """Same check with tighter plausibility bounds (temp <= 50, wind <= 45)."""
    return _validation_report(P.validate_profile(daily(spark, sf_dir),
                                                 temp_range=(-50.0, 50.0),
                                                 wind_range=(0.0, 45.0)))


@register("monthly_nulls", with_views(ctes("daily", extra=[_quality_cte(60, 60)]),
                                       "SELECT * FROM mq"))
def monthly_nulls(spark, sf_dir):
    """Missing and implausible measures per (location, month)."""
    return P.monthly_quality(daily(spark, sf_dir))


@register("profile_document", with_views(ctes("daily", extra=[
    ENRICHED_CTE, "nm AS (SELECT country, city, count(DISTINCT month) >= 12 AS is_valid "
    "FROM eprof GROUP BY country, city)"]), f"""
SELECT eprof.country, eprof.city, nm.is_valid, month, {MONTH_NAME} AS month_name,
       temp_mean, temp_stddev, temp_median, temp_q75 - temp_q25 AS temp_iqr,
       wind_mean, wind_stddev, wind_q75 - wind_q25 AS wind_iqr, precipitation_max, days_count
FROM eprof JOIN nm ON nm.country = eprof.country AND nm.city = eprof.city"""))
def profile_document(spark, sf_dir):
    """Documents built (sorted month array per location) and exploded back."""
    return P.explode_profiles(_validated_documents(daily(spark, sf_dir)))


def _validated_documents(d, year=None):
    """One pass over the history: the monthly aggregate (12 rows per
    location) carries the quality counts, is materialised once, and feeds
    both the month array and the validation report."""
    monthly = materialize(P.enriched_profile(d, with_quality=True))
    return P.profile_document(monthly, P.validation_from_monthly(monthly), year=year,
                              digits=None)


@register("profile_document_year", with_views(ctes("daily", extra=[
    ENRICHED_CTE.replace("FROM daily GROUP BY", "FROM daily WHERE year(date) = 1998 GROUP BY"),
    "nm AS (SELECT country, city, count(DISTINCT month) >= 12 AS is_valid "
    "FROM eprof GROUP BY country, city)"]), f"""
SELECT eprof.country, eprof.city, '1998' AS year, nm.is_valid, month,
       {MONTH_NAME} AS month_name, temp_mean, temp_stddev, temp_median,
       temp_q75 - temp_q25 AS temp_iqr, wind_mean, wind_stddev, wind_q75 - wind_q25 AS wind_iqr,
       precipitation_max, days_count
FROM eprof JOIN nm ON nm.country = eprof.country AND nm.city = eprof.city"""))
def profile_document_year(spark, sf_dir):
    """Validated profile documents of one year: the year filters the history
    and tags the documents."""
    docs = _validated_documents(daily(spark, sf_dir, year=1998), year=1998)
    return P.explode_profiles(docs.select("country", "city", "year", "validation",
                                          "profiles"), keys=("country", "city", "year"))


ANOMALY_CTES = [PROFILE_CTE, """j AS (
  SELECT o.event_time AS event_timestamp, o.country, o.city,
         CAST(month(o.event_time) AS INTEGER) AS month, o.temperature, o.windspeed,
         p.temp_mean AS tm, p.temp_stddev AS tsd, p.wind_mean AS wm, p.wind_stddev AS wsd
  FROM obs o LEFT JOIN prof p
    ON o.country = p.country AND o.city = p.city
   AND CAST(month(o.event_time) AS INTEGER) = p.month)""", """f AS (
  SELECT *, coalesce(abs(temperature - tm) > tsd * 2, false) AS t_out,
            coalesce(abs(windspeed - wm) > wsd * 2, false) AS w_out FROM j)""", """a AS (
  SELECT event_timestamp, country, city, month, temperature, windspeed,
         (t_out OR w_out) AS is_anomaly,
         CASE WHEN t_out THEN CASE WHEN temperature > tm THEN 'heat_wave' ELSE 'cold_wave' END
              WHEN w_out THEN 'wind_storm' END AS anomaly_type,
         CASE WHEN t_out THEN 'temperature' WHEN w_out THEN 'windspeed' END AS variable,
         CASE WHEN t_out THEN temperature WHEN w_out THEN windspeed END AS observed_value,
         CASE WHEN t_out THEN tm WHEN w_out THEN wm END AS expected_value,
         CASE WHEN t_out THEN abs(temperature - tm) WHEN w_out THEN abs(windspeed - wm) END
           AS deviation,
         CASE WHEN t_out THEN tsd * 2 WHEN w_out THEN wsd * 2 END AS threshold
  FROM f)"""]


def anomalies_all(spark, sf_dir, only_anomalies=True):
    base = A.baseline(P.seasonal_profile(daily(spark, sf_dir)))
    return A.detect_anomalies_checked(obs(spark, sf_dir), base,
                                      only_anomalies=only_anomalies)


@register("anomalies", with_views(ctes("obs", "daily", extra=ANOMALY_CTES),
                                   "SELECT * FROM a WHERE is_anomaly"))
def anomalies(spark, sf_dir):
    """Observations more than 2 sigma from their location-month profile."""
    return anomalies_all(spark, sf_dir)


@register("anomaly_classification", with_views(ctes("obs", "daily", extra=ANOMALY_CTES), """
SELECT country, city, coalesce(anomaly_type, 'none') AS anomaly_type, count(*) AS n
FROM a GROUP BY ALL"""))
def anomaly_classification(spark, sf_dir):
    """Every observation classified (normal rows as ``none``), counted."""
    a = anomalies_all(spark, sf_dir, only_anomalies=False)
    return (a.groupBy("country", "city",
                      F.coalesce("anomaly_type", F.lit("none")).alias("anomaly_type"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("anomaly_feed", with_views(ctes("obs", "daily", extra=ANOMALY_CTES), """
SELECT strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_time_text, country, city,
       upper(replace(anomaly_type, '_', ' ')) AS anomaly_label, variable,
       CASE WHEN variable = 'temperature' THEN '°C' ELSE 'm/s' END AS unit,
       observed_value, expected_value, deviation, threshold,
       CASE WHEN expected_value = 0 THEN NULL
            ELSE (observed_value - expected_value) / expected_value * 100 END AS pct_deviation
FROM a WHERE is_anomaly"""))
def anomaly_feed(spark, sf_dir):
    """Anomaly read-out: formatted time, label, unit, percent gap."""
    return A.anomaly_feed(anomalies_all(spark, sf_dir))


ROUNDED_DOCUMENT = StructType([StructField("city", StringType()), StructField("country", StringType()), StructField(
    "profiles", ArrayType(StructType([StructField("month", IntegerType()), *[StructField(c, DoubleType()) for c in (
        "temp_mean", "precipitation_mean", "heat_alert_probability")], StructField("days_count", LongType())])))])


@register("profile_documents_rounded", with_views(ctes("daily"), f"""
SELECT country, city, CAST(month(date) AS INTEGER) AS month,
       {sql_rounded_ratio("CAST(sum(CAST(round(temp_mean * 1000000) AS BIGINT)) AS HUGEINT)", "count(temp_mean)", 2, 6)} AS temp_mean,
       {sql_rounded_ratio("CAST(sum(CAST(precipitation AS BIGINT)) AS HUGEINT)", "count(precipitation)", 2, 0)}
         AS precipitation_mean,
       {sql_rounded_ratio(f"count(CASE WHEN {_LVL_T} >= 1 THEN 1 END)", "count(*)", 4, 0)} AS heat_alert_probability,
       count(*) AS days_count
FROM daily GROUP BY country, city, month(date)"""))
def profile_documents_rounded(spark, sf_dir):
    """Monthly profiles rounded to 2 places (probabilities to 4) by exact
    means, written as one document per location, half of the locations
    replaced by a second run, and read back."""
    path = scratch_path(spark, "rounded-documents")
    months = daily(spark, sf_dir).groupBy("country", "city", F.month("date").alias("month")).agg(
        exact_mean("temp_mean", 2).alias("temp_mean"), exact_mean("precipitation", 2, 0).alias("precipitation_mean"),
        exact_share(heat_level_num("temp_mean") >= 1, 4).alias("heat_alert_probability"),
        F.count(F.lit(1)).alias("days_count"))
    month = F.struct("month", "temp_mean", "precipitation_mean", "heat_alert_probability", "days_count")
    docs = materialize(months.groupBy("country", "city").agg(F.sort_array(F.collect_list(month)).alias("profiles")))
    swap_documents(docs, path)
    swap_documents(docs.filter(F.xxhash64("city") % 2 == 0), path)
    back = read_json_documents(spark, f"{path}/*/*/*.json", ROUNDED_DOCUMENT)
    return back.select("country", "city", F.inline("profiles"))


# Two versions of the profile: the second half of the time meets one whose
# mean temperatures are PROFILE_SHIFT higher.
PROFILE_SHIFT = 5.0
VERSIONED_SQL = with_views(ctes("obs", "daily", extra=[
    "span AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM obs)", ANOMALY_CTES[0],
    ANOMALY_CTES[1].replace("p.temp_mean AS tm", f"p.temp_mean + (v - 1) * {PROFILE_SHIFT} AS tm, v").replace(
        "FROM obs o", "FROM (SELECT obs.*, (epoch_us(event_time) - lo) * 2 // (hi - lo + 1) + 1 AS v FROM obs, span) o"),
    ANOMALY_CTES[2], ANOMALY_CTES[3].replace("temperature, windspeed,\n", "temperature, windspeed, v,\n", 1)]),
    "SELECT * EXCLUDE (v), CAST(v AS INTEGER) AS profile_version FROM a WHERE is_anomaly")


# Oracle texts reused by the streaming twins of these queries.
ORACLES_FOR_STREAMS = {name: ORACLES[name] for name in ['anomalies']}
