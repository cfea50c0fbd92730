"""Report queries (overview, real-time view, weather per country, city
statistics, history evolution, store audit, cycle summary)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from squall.functions.names import safe_name
from squall.operators import reports as RP
from squall.plans.registry import ORACLES, register
from squall.plans.speed import classified
from squall.plans.sqlviews import ctes, with_views
from squall.schemas import STORED_ALERT
from squall.session import scratch_path
from squall.sinks.files import with_location_dirs, write_location_store
from squall.functions.parsing import tolerant_timestamp
from squall.sources.files import read_location_store, split_store
from squall.sources.files import store_catalogue as list_store
from squall.sources.testviews import daily, obs

WEATHER_LABEL_SQL = ("CASE weather_code WHEN 0 THEN 'Ciel dégagé' WHEN 1 THEN 'Dégagé' "
                     "WHEN 2 THEN 'Nuageux' WHEN 3 THEN 'Couvert' WHEN 45 THEN 'Brouillard' "
                     "WHEN 61 THEN 'Pluie légère' WHEN 63 THEN 'Pluie modérée' "
                     "WHEN 65 THEN 'Pluie forte' WHEN 95 THEN 'Orage' "
                     "ELSE 'Code ' || CAST(weather_code AS VARCHAR) END")


@register("kpis", with_views(ctes("cobs"), """
SELECT count(*) AS total_alerts, count(DISTINCT country) AS countries,
       count(DISTINCT city) AS cities, avg(temperature) AS avg_temperature,
       avg(windspeed) AS avg_windspeed
FROM cobs WHERE event_time IS NOT NULL"""))
def kpis(spark, sf_dir):
    """Overview KPIs: rows, countries, cities, mean temperature and wind."""
    return RP.kpis(classified(spark, sf_dir))


@register("city_overview", with_views(ctes("cobs"), """
SELECT city, country, count(*) AS alert_count, avg(temperature) AS avg_temperature,
       avg(windspeed) AS avg_windspeed
FROM cobs WHERE city IS NOT NULL AND country IS NOT NULL GROUP BY city, country"""))
def city_overview(spark, sf_dir):
    """Rows, mean temperature and wind per city, busiest first."""
    return RP.city_overview(classified(spark, sf_dir))


@register("city_stats", with_views(ctes("cobs"), """
SELECT country, city, avg(temperature) AS temp_mean, min(temperature) AS temp_min,
       max(temperature) AS temp_max, avg(windspeed) AS wind_mean, max(windspeed) AS wind_max,
       count(*) FILTER (WHERE wind_alert_level IS DISTINCT FROM 'level_0') AS wind_alerts,
       count(*) FILTER (WHERE heat_alert_level IS DISTINCT FROM 'level_0') AS heat_alerts
FROM cobs WHERE country IS NOT NULL AND city IS NOT NULL GROUP BY country, city"""))
def city_stats(spark, sf_dir):
    """Temperature / wind statistics and raised-level counts per city."""
    return RP.city_stats(classified(spark, sf_dir))


@register("level_counts", with_views(ctes("cobs"), """
SELECT 'wind' AS kind, wind_alert_level AS level, count(*) AS n FROM cobs
WHERE wind_alert_level IS NOT NULL GROUP BY wind_alert_level
UNION ALL
SELECT 'heat' AS kind, heat_alert_level AS level, count(*) AS n FROM cobs
WHERE heat_alert_level IS NOT NULL GROUP BY heat_alert_level"""))
def level_counts(spark, sf_dir):
    """Value counts of the wind and heat levels."""
    return RP.level_counts(classified(spark, sf_dir))


@register("weather_by_country", with_views(ctes("cobs"), f"""
SELECT country, {WEATHER_LABEL_SQL} AS weather_description, count(*) AS count
FROM cobs WHERE country IS NOT NULL GROUP BY ALL"""))
def weather_by_country(spark, sf_dir):
    """Row count per (country, weather label)."""
    return RP.weather_by_country(classified(spark, sf_dir))


@register("top_weather_by_country", with_views(ctes("cobs", extra=[
    f"c AS (SELECT country, {WEATHER_LABEL_SQL} AS weather_description, count(*) AS count "
    "FROM cobs WHERE country IS NOT NULL GROUP BY ALL)"]), """
SELECT country, weather_description, count FROM (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY count DESC,
                               weather_description) AS rn FROM c) WHERE rn = 1"""))
def top_weather_by_country(spark, sf_dir):
    """Most frequent weather label per country (alphabetical on ties)."""
    return RP.top_weather_by_country(classified(spark, sf_dir))


@register("latest_50", with_views(ctes("cobs"), """
SELECT * FROM cobs ORDER BY event_time DESC, event_id DESC LIMIT 50"""))
def latest_50(spark, sf_dir):
    """The 50 most recent observations."""
    return RP.latest(classified(spark, sf_dir), 50)


@register("realtime_view", with_views(ctes("cobs"), """
SELECT event_id, event_time, city, country, temperature, windspeed,
       wind_alert_level, heat_alert_level
FROM cobs WHERE event_time IS NOT NULL AND country = 'EUROPE'"""))
def realtime_view(spark, sf_dir):
    """Country filter (the page's selector) and time order."""
    return (RP.filtered_view(classified(spark, sf_dir), country="EUROPE")
            .select("event_id", "event_time", "city", "country", "temperature",
                    "windspeed", "wind_alert_level", "heat_alert_level"))


@register("pick_lists", with_views(ctes("obs"), """
SELECT DISTINCT country, city FROM obs WHERE country IS NOT NULL AND city IS NOT NULL"""))
def pick_lists(spark, sf_dir):
    """Sorted distinct (country, city) pairs."""
    return RP.pick_lists(obs(spark, sf_dir))


@register("yearly_evolution", with_views(ctes("daily"), """
SELECT country, city, CAST(year(date) AS INTEGER) AS year, avg(temp_mean) AS temp_mean,
       avg(windspeed_max) AS wind_mean, sum(precipitation) AS precipitation_total
FROM daily GROUP BY ALL"""))
def yearly_evolution(spark, sf_dir):
    """Yearly mean temperature, mean wind and total precipitation per location."""
    return RP.yearly_evolution(daily(spark, sf_dir))


@register("month_year_pivot", with_views(ctes("daily"), """
SELECT country, city, CAST(month(date) AS INTEGER) AS month,
       CAST(year(date) AS VARCHAR) AS year, avg(temp_mean) AS temp_mean
FROM daily GROUP BY ALL"""))
def month_year_pivot(spark, sf_dir):
    """Mean temperature per month and year: pivoted to one column for every
    year present, then listed, so the result's columns do not depend on the
    data."""
    keys = ["country", "city", "month"]
    table = RP.month_year_table(daily(spark, sf_dir))
    years = [c for c in table.columns if c not in keys]
    return table.unpivot(keys, years, "year", "temp_mean").filter("temp_mean IS NOT NULL")


@register("cycle_summary", with_views(ctes("obs", extra=[
    "pc AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS cycle_start, country, city, "
    "avg(temperature) AS temperature, avg(windspeed) AS windspeed, avg(humidity) AS humidity "
    "FROM obs GROUP BY ALL)"]), """
SELECT cycle_start, country, city, temperature, windspeed, humidity, 'city' AS row_kind FROM pc
UNION ALL
SELECT cycle_start, NULL, NULL, avg(temperature), avg(windspeed), avg(humidity), 'mean'
FROM pc GROUP BY cycle_start"""))
def cycle_summary(spark, sf_dir):
    """Per hourly cycle: one row per city plus an unweighted mean row."""
    return RP.cycle_summary(obs(spark, sf_dir), cycle="1 hour")


def stored_alerts(spark, sf_dir):
    """Classified observations written to the per-location store in the
    shared folder and read back (store -> scan round trip)."""
    schema = StructType([StructField("event_id", LongType())] + list(STORED_ALERT.fields))
    return read_location_store(spark, _write_alerts(spark, sf_dir), schema)


def _write_alerts(spark, sf_dir):
    path = scratch_path(spark, "alert-store")
    alerts = classified(spark, sf_dir).select(
        "event_id", F.col("original_timestamp").alias("event_time"), "city", "country",
        F.lit(None).cast("string").alias("country_code"), "temperature", "windspeed",
        "wind_alert_level", "heat_alert_level", "weather_code", "humidity", "precipitation")
    write_location_store(alerts, path)
    return path


_STORE_SQL = ("st AS (SELECT replace(replace(replace(country, ' ', '_'), '/', '_'), '''', '') "
              "AS country_dir, replace(replace(replace(city, ' ', '_'), '/', '_'), '''', '') "
              "AS city_dir, * FROM cobs)")


@register("store_audit", with_views(ctes("cobs", extra=[_STORE_SQL]), """
SELECT country_dir, city_dir, CAST(grouping(country_dir, city_dir) AS INTEGER) AS level,
       count(*) AS n_alerts
FROM st GROUP BY ROLLUP (country_dir, city_dir)"""))
def store_audit(spark, sf_dir):
    """Row count per stored location with country subtotals and the total."""
    s = stored_alerts(spark, sf_dir)
    return (s.rollup("country_dir", "city_dir")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.count(F.lit(1)).alias("n_alerts")))


@register("store_sample", with_views(ctes("cobs", extra=[_STORE_SQL]), """
SELECT country_dir, city_dir, event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')
       AS event_time, temperature, windspeed, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY country_dir, city_dir
                               ORDER BY event_time, event_id) AS rank FROM st)
WHERE rank <= 5"""))
def store_sample(spark, sf_dir):
    """First five stored rows of every location (store read-back sample)."""
    s = stored_alerts(spark, sf_dir)
    return (RP.first_rows_per_location(s, 5, keys=("country_dir", "city_dir"))
            .select("country_dir", "city_dir", "event_id", "event_time", "temperature",
                    "windspeed", "rank"))


@register("store_kpis", ORACLES["kpis"])
def store_kpis(spark, sf_dir):
    """Overview KPIs over the stored alerts read back from the store (event
    times are text there and are parsed tolerantly; unparseable rows drop)."""
    s = stored_alerts(spark, sf_dir)
    return RP.kpis(s.withColumn("event_time", tolerant_timestamp("event_time")))


@register("store_catalogue", with_views(ctes("cobs", extra=[_STORE_SQL]), """
SELECT DISTINCT country_dir, city_dir FROM st"""))
def store_catalogue(spark, sf_dir):
    """Which locations have stored alerts: folder names from the listing of
    the store, whose files are not read."""
    return list_store(spark, _write_alerts(spark, sf_dir))


@register("store_scan", with_views(ctes("cobs", extra=[_STORE_SQL]), """
SELECT country_dir, city_dir, count(*) FILTER (event_id % 10 > 1) AS n_rows,
       count(*) FILTER (event_id % 10 <= 1) AS n_rejects,
       max(temperature) FILTER (event_id % 10 > 1) AS max_temperature
FROM st GROUP BY country_dir, city_dir"""))
def store_scan(spark, sf_dir):
    """Scan of the per-location alert files when every tenth line is cut off,
    another tenth has a text for a number, and blank lines stand between:
    rows and rejects of each location."""
    path = scratch_path(spark, "alert-lines")
    alerts = with_location_dirs(classified(spark, sf_dir))
    line = F.to_json(F.struct(F.col("original_timestamp").alias("event_time"), "city", "country", "temperature",
                              "windspeed", "wind_alert_level", "heat_alert_level", "weather_code"))
    kind = F.col("event_id") % 10
    lines = alerts.select("event_id", "country_dir", "city_dir", line.alias("line"))
    damaged = (F.when(kind == 0, F.expr("left(line, length(line) - 9)"))
               .when(kind == 1, F.regexp_replace("line", '"windspeed":[^,]*', '"windspeed":"calm"'))
               .when(kind == 2, F.concat("line", F.lit("\n  "))).otherwise(F.col("line")))
    lines.select("country_dir", "city_dir", damaged.alias("value")).write.partitionBy("country_dir", "city_dir").text(path)
    rows, rejects = split_store(spark, path)
    both = rows.select("country_dir", "city_dir", "temperature", F.lit(True).alias("ok")).unionByName(
        rejects.select("country_dir", "city_dir", F.lit(None).cast("double").alias("temperature"), F.lit(False).alias("ok")))
    return both.groupBy("country_dir", "city_dir").agg(
        F.count_if("ok").alias("n_rows"), F.count_if(~F.col("ok")).alias("n_rejects"),
        F.max("temperature").alias("max_temperature"))


@register("safe_location", with_views(ctes("obs"), """
SELECT event_id, country, city,
       replace(replace(country, ' ', '_'), '/', '_') AS country_basic,
       replace(replace(replace(country, ' ', '_'), '/', '_'), '''', '') AS country_dir,
       replace(replace(replace(replace(country, ' ', '_'), '/', '_'), '-', '_'), '''', '')
         AS country_strict,
       replace(replace(replace(country, ' ', '_'), '/', '_'), '''', '') || '/' ||
       replace(replace(replace(city, ' ', '_'), '/', '_'), '''', '') AS location
FROM obs"""))
def safe_location(spark, sf_dir):
    """Path-safe folder names (three rule sets) and the location key."""
    o = obs(spark, sf_dir)
    return o.select("event_id", "country", "city",
                    safe_name("country", "basic").alias("country_basic"),
                    safe_name("country").alias("country_dir"),
                    safe_name("country", "strict").alias("country_strict"),
                    F.concat_ws("/", safe_name("country"), safe_name("city")).alias("location"))


# Oracle texts reused by the streaming twins of these queries.
ORACLES_FOR_STREAMS = {name: ORACLES[name] for name in ['store_audit']}
