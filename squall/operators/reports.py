"""Report queries over stored alerts / classified observations and over
the daily history (overview KPIs, per-city tables, level distributions,
most frequent weather per country, latest rows, yearly evolution and the
month x year table, cycle summaries).

Null grouping keys are dropped before grouping, as a report over named
places expects; every aggregate is a partial + final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.functions.classify import critical_flag
from squall.functions.labels import weather_label
from squall.functions.parsing import tolerant_timestamp, with_defaults


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def kpis(alerts: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """One row: total rows, distinct countries and cities, mean temperature
    and wind (rows without a parseable time are dropped first).

    The rows are aggregated per place first, so the distinct counts expand
    one row per place, not the observations."""
    places = drop_null_keys(alerts, ts_col).groupBy("country", "city").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("temperature").alias("t"), F.count("temperature").alias("nt"),
        F.sum("windspeed").alias("w"), F.count("windspeed").alias("nw"))
    return places.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_alerts"),
                      F.count_distinct("country").alias("countries"),
                      F.count_distinct("city").alias("cities"),
                      F.try_divide(F.sum("t"), F.sum("nt")).alias("avg_temperature"),
                      F.try_divide(F.sum("w"), F.sum("nw")).alias("avg_windspeed"))


def city_overview(alerts: DataFrame) -> DataFrame:
    """Rows, mean temperature and wind per (city, country), busiest first."""
    return (drop_null_keys(alerts, "city", "country")
            .groupBy("city", "country")
            .agg(F.count(F.lit(1)).alias("alert_count"),
                 F.avg("temperature").alias("avg_temperature"),
                 F.avg("windspeed").alias("avg_windspeed"))
            .orderBy(F.desc("alert_count"), "country", "city"))


def _raised(level_col: str):
    """Rows whose level is not ``level_0`` (a missing level counts as raised)."""
    return F.count_if(~F.col(level_col).eqNullSafe("level_0"))


def city_stats(alerts: DataFrame, digits: int | None = None) -> DataFrame:
    """Per (country, city): temperature mean/min/max, wind mean/max and the
    number of raised wind / heat levels."""
    agg = (drop_null_keys(alerts, "country", "city")
           .groupBy("country", "city")
           .agg(F.avg("temperature").alias("temp_mean"),
                F.min("temperature").alias("temp_min"),
                F.max("temperature").alias("temp_max"),
                F.avg("windspeed").alias("wind_mean"),
                F.max("windspeed").alias("wind_max"),
                _raised("wind_alert_level").alias("wind_alerts"),
                _raised("heat_alert_level").alias("heat_alerts")))
    if digits is not None:
        agg = agg.withColumns({c: F.round(c, digits) for c in
                               ("temp_mean", "temp_min", "temp_max", "wind_mean", "wind_max")})
    return agg


def level_counts(alerts: DataFrame) -> DataFrame:
    """Value counts of the wind and heat levels in one scan, descending."""
    pairs = F.explode(F.array(
        F.struct(F.lit("wind").alias("kind"), F.col("wind_alert_level").alias("level")),
        F.struct(F.lit("heat").alias("kind"), F.col("heat_alert_level").alias("level"))))
    return (alerts.select(pairs.alias("p")).select("p.kind", "p.level")
            .filter(F.col("level").isNotNull())
            .groupBy("kind", "level").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("kind", F.desc("n"), "level"))


def weather_by_country(alerts: DataFrame) -> DataFrame:
    return (drop_null_keys(alerts, "country")
            .groupBy("country", weather_label("weather_code").alias("weather_description"))
            .agg(F.count(F.lit(1)).alias("count")))


def top_weather_by_country(alerts: DataFrame) -> DataFrame:
    """Most frequent weather label per country (alphabetical on ties).

    Two aggregations: counts per (country, label), then the best label per
    country with ``min_by`` over (-count, label) — no sort of the data.
    """
    counts = weather_by_country(alerts)
    return counts.groupBy("country").agg(
        F.min_by("weather_description",
                 F.struct(-F.col("count"), F.col("weather_description")))
        .alias("weather_description"),
        F.max("count").alias("count"))


def latest(alerts: DataFrame, n: int = 50, ts_col: str = "event_time",
           tie_col: str = "event_id") -> DataFrame:
    """The ``n`` most recent rows (top-k: per-partition top-n, then merge)."""
    return alerts.orderBy(F.col(ts_col).desc(), F.col(tie_col).desc()).limit(n)


def filtered_view(alerts: DataFrame, country: str | None = None,
                  city: str | None = None, ts_col: str = "event_time") -> DataFrame:
    """Optional country / city filters, ordered by time."""
    df = drop_null_keys(alerts, ts_col)
    if country is not None:
        df = df.filter(F.col("country") == country)
    if city is not None:
        df = df.filter(F.col("city") == city)
    return df.orderBy(ts_col, "event_id")


def pick_lists(alerts: DataFrame) -> DataFrame:
    """Sorted distinct (country, city) pairs for selection lists."""
    return (drop_null_keys(alerts, "country", "city").select("country", "city")
            .distinct().orderBy("country", "city"))


def first_rows_per_location(alerts: DataFrame, n: int = 5, ts_col: str = "event_time",
                            keys=("country", "city"), tie_col: str = "event_id") -> DataFrame:
    """First ``n`` rows of each location by time.  The ``row_number() <= n``
    filter lets Spark cut every group to ``n`` rows per map task before the
    shuffle (window group limit), so a hot location does not move whole."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts_col), F.col(tie_col))
    return (alerts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n))


def yearly_evolution(daily: DataFrame, keys=("country", "city")) -> DataFrame:
    return (daily.groupBy(*keys, F.year("date").alias("year"))
            .agg(F.avg("temp_mean").alias("temp_mean"),
                 F.avg("windspeed_max").alias("wind_mean"),
                 F.sum("precipitation").alias("precipitation_total")))


def month_year_table(daily: DataFrame, years: list[int] | None = None,
                     keys=("country", "city")) -> DataFrame:
    """Mean temperature pivoted to one column per year, one row per month.

    Passing ``years`` avoids the extra job that discovers the pivot values.
    """
    df = daily.withColumns({"year": F.year("date"), "month": F.month("date")})
    grouped = df.groupBy(*keys, "month")
    pivoted = grouped.pivot("year", years) if years is not None else grouped.pivot("year")
    return pivoted.agg(F.avg("temp_mean"))


def cycle_summary(obs: DataFrame, cycle: str = "30 seconds", ts_col: str = "event_time",
                  keys=("country", "city")) -> DataFrame:
    """Per emission cycle: one row per location (cycle means) plus one
    unweighted mean row over the locations of the cycle.

    Both levels come from one ``rollup`` over the per-location rows (the
    location level averages a single row, i.e. returns it), so the
    observations are aggregated once."""
    per_city = (obs.groupBy(F.window(ts_col, cycle).start.alias("cycle_start"),
                            F.struct(*keys).alias("loc"))
                .agg(F.avg("temperature").alias("t"), F.avg("windspeed").alias("w"),
                     F.avg("humidity").alias("h")))
    levels = (per_city.rollup("cycle_start", "loc")
              .agg(F.avg("t").alias("temperature"), F.avg("w").alias("windspeed"),
                   F.avg("h").alias("humidity"), F.grouping_id().alias("_g"))
              .filter(F.col("_g") < 3))
    return levels.select(
        "cycle_start", *[F.col(f"loc.{k}").alias(k) for k in keys],
        "temperature", "windspeed", "humidity",
        F.when(F.col("_g") == 0, "city").otherwise("mean").alias("row_kind"))


def alert_feed(messages: DataFrame, ts_col: str = "event_time",
               fallback_now: bool = False) -> DataFrame:
    """Alert read-out of classified messages: tolerant time parse (null, or
    the processing time with ``fallback_now``), field defaults, and the
    level-2 highlight."""
    m = with_defaults(messages)
    return m.select(
        F.date_format(tolerant_timestamp(ts_col, fallback_now), "yyyy-MM-dd HH:mm:ss")
        .alias("event_time_text"),
        "city", "country", "temperature", "windspeed", "heat_alert_level",
        "wind_alert_level", critical_flag().alias("is_critical"))
