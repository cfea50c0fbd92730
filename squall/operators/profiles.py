"""Monthly climate profiles per location, their validation and the
document form.

All statistics are hash aggregates grouped by (location, month) with a
map-side partial step; ``percentile_approx`` keeps a bounded-size sketch per
group, so a location holding a large share of the rows costs memory in
proportion to the sketch, not to its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions.classify import heat_level_num, wind_level_num
from squall.functions.labels import month_name_fr

LOCATION = ("country", "city")

# Plausibility bounds of the validation step.
TEMP_RANGE = (-50.0, 60.0)
WIND_RANGE = (0.0, 60.0)

# Validation messages (French, as stored in the documents).
MSG_INCOMPLETE = "Profil incomplet: seulement {n}/12 mois présents"
MSG_NULL_TEMP = "Mois {month}: {n} valeurs de température manquantes"
MSG_NULL_WIND = "Mois {month}: {n} valeurs de vent manquantes"
MSG_UNREALISTIC = "{n} valeurs non réalistes détectées"


def for_year(daily: DataFrame, year: int | None, date_col: str = "date") -> DataFrame:
    """Restrict the history to one calendar year (``None``: all years).

    Written as a date range (not ``year(date) = y``) so the predicate can
    reach the scan as a pushed filter / partition filter."""
    if year is None:
        return daily
    d = F.col(date_col)
    return daily.filter((d >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
                        & (d < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))


def with_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn("month", F.month(F.col(date_col)))


def _share(cond: Column) -> Column:
    """Share of rows meeting ``cond`` (0..1)."""
    return F.count(F.when(cond, True)) / F.count(F.lit(1))


def seasonal_profile(daily: DataFrame, keys=LOCATION) -> DataFrame:
    """Basic monthly profile: means, sample std-devs, extremes, alert shares."""
    df = with_month(daily).withColumns({
        "heat_alert_level": heat_level_num("temp_mean"),
        "wind_alert_level": wind_level_num("windspeed_max")})
    return df.groupBy(*keys, "month").agg(
        F.avg("temp_mean").alias("temp_mean"),
        F.avg("temp_max").alias("temp_max"),
        F.avg("temp_min").alias("temp_min"),
        F.stddev_samp("temp_mean").alias("temp_stddev"),
        F.min("temp_min").alias("temp_abs_min"),
        F.max("temp_max").alias("temp_abs_max"),
        F.avg("windspeed_max").alias("wind_mean"),
        F.avg("windgusts_max").alias("windgust_mean"),
        F.stddev_samp("windspeed_max").alias("wind_stddev"),
        F.max("windgusts_max").alias("wind_abs_max"),
        F.avg("precipitation").alias("precipitation_mean"),
        F.avg("rain").alias("rain_mean"),
        F.avg("snowfall").alias("snowfall_mean"),
        _share(F.col("heat_alert_level") >= 1).alias("heat_alert_probability"),
        _share(F.col("wind_alert_level") >= 1).alias("wind_alert_probability"),
        F.count(F.lit(1)).alias("days_count"))


def _quality_aggs(temp_range=TEMP_RANGE, wind_range=WIND_RANGE) -> list[Column]:
    t, w = F.col("temp_mean"), F.col("windspeed_max")
    implausible = ((t < temp_range[0]) | (t > temp_range[1])
                   | (w < wind_range[0]) | (w > wind_range[1]))
    return [F.count(F.when(t.isNull(), 1)).alias("null_temp"),
            F.count(F.when(w.isNull(), 1)).alias("null_wind"),
            F.count(F.when(implausible, 1)).alias("unrealistic")]


def enriched_profile(daily: DataFrame, keys=LOCATION, accuracy: int = 10000,
                     with_quality: bool = False, temp_range=TEMP_RANGE,
                     wind_range=WIND_RANGE) -> DataFrame:
    """Monthly profile with quartiles, medians, IQR and precipitation spread.

    ``with_quality`` adds the per-month missing / implausible counts, so the
    validation report can be derived from the same aggregate
    (``validation_from_monthly``) without a second pass over the history."""
    df = with_month(daily)
    quality = _quality_aggs(temp_range, wind_range) if with_quality else []

    def quartiles(c):
        # one sketch for the three of them
        return F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)

    agg = df.groupBy(*keys, "month").agg(
        F.avg("temp_mean").alias("temp_mean"),
        F.avg("temp_max").alias("temp_max"),
        F.avg("temp_min").alias("temp_min"),
        F.stddev_samp("temp_mean").alias("temp_stddev"),
        F.min("temp_min").alias("temp_abs_min"),
        F.max("temp_max").alias("temp_abs_max"),
        quartiles("temp_mean").alias("_temp"),
        F.avg("windspeed_max").alias("wind_mean"),
        F.avg("windgusts_max").alias("windgust_mean"),
        F.stddev_samp("windspeed_max").alias("wind_stddev"),
        F.min("windspeed_max").alias("wind_abs_min"),
        F.max("windgusts_max").alias("wind_abs_max"),
        quartiles("windspeed_max").alias("_wind"),
        F.avg("precipitation").alias("precipitation_mean"),
        F.stddev_samp("precipitation").alias("precipitation_stddev"),
        F.max("precipitation").alias("precipitation_max"),
        F.count(F.lit(1)).alias("days_count"), *quality)
    values = {f"{m}_{name}": F.col(f"_{m}")[i] for m in ("temp", "wind")
              for i, name in enumerate(("q25", "median", "q75"))}
    spread = {f"{m}_iqr": F.col(f"_{m}")[2] - F.col(f"_{m}")[0] for m in ("temp", "wind")}
    return agg.withColumns({**values, **spread}).drop("_temp", "_wind")


def annual_summary(profile: DataFrame, keys=LOCATION) -> DataFrame:
    """Unweighted mean of the monthly means; hottest, coldest and windiest
    month (the earliest month on ties)."""
    p = profile.withColumn("month_name", month_name_fr("month"))
    m = F.col("month")
    return p.groupBy(*keys).agg(
        F.avg("temp_mean").alias("annual_temp_mean"),
        F.avg("wind_mean").alias("annual_wind_mean"),
        F.max_by("month_name", F.struct("temp_mean", -m)).alias("hottest_month"),
        F.max("temp_mean").alias("hottest_month_temp"),
        F.min_by("month_name", F.struct("temp_mean", m)).alias("coldest_month"),
        F.min("temp_mean").alias("coldest_month_temp"),
        F.max_by("month_name", F.struct("wind_mean", -m)).alias("windiest_month"),
        F.max("wind_mean").alias("windiest_month_wind"),
        F.count(F.lit(1)).alias("months"))


def monthly_quality(daily: DataFrame, keys=LOCATION, temp_range=TEMP_RANGE,
                    wind_range=WIND_RANGE) -> DataFrame:
    """Per (location, month): missing measures and implausible rows."""
    return with_month(daily).groupBy(*keys, "month").agg(
        *_quality_aggs(temp_range, wind_range), F.count(F.lit(1)).alias("days_count"))


def _fmt(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` placeholders of a fixed message with column values."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), cols[name].cast("string")]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def validate_profile(daily: DataFrame, keys=LOCATION, temp_range=TEMP_RANGE,
                     wind_range=WIND_RANGE) -> DataFrame:
    """Validation report per location: 12 months present (else an error),
    warnings for missing measures per month and for implausible values.

    One aggregation to (location, month), then one to location; the
    per-location arrays hold at most two messages per month.
    """
    return validation_from_monthly(monthly_quality(daily, keys, temp_range, wind_range), keys)


def validation_from_monthly(mq: DataFrame, keys=LOCATION) -> DataFrame:
    """Validation report from per-(location, month) rows carrying
    ``null_temp``, ``null_wind`` and ``unrealistic`` counts."""
    month = F.col("month")
    warn_temp = F.when(F.col("null_temp") > 0,
                       F.struct(month.alias("m"), F.lit(0).alias("k"),
                                _fmt(MSG_NULL_TEMP, month=month, n=F.col("null_temp")).alias("msg")))
    warn_wind = F.when(F.col("null_wind") > 0,
                       F.struct(month.alias("m"), F.lit(1).alias("k"),
                                _fmt(MSG_NULL_WIND, month=month, n=F.col("null_wind")).alias("msg")))
    per_loc = mq.groupBy(*keys).agg(
        F.count_distinct("month").alias("months_present"),
        F.sum("unrealistic").alias("unrealistic_count"),
        F.sort_array(F.filter(F.flatten(F.collect_list(F.array(warn_temp, warn_wind))),
                              lambda x: x.isNotNull())).alias("_w"))
    n_months = F.col("months_present")
    n_bad = F.col("unrealistic_count")
    errors = F.when(n_months < 12, F.array(_fmt(MSG_INCOMPLETE, n=n_months))) \
        .otherwise(F.array().cast("array<string>"))
    warnings = F.concat(F.transform("_w", lambda x: x["msg"]),
                        F.when(n_bad > 0, F.array(_fmt(MSG_UNREALISTIC, n=n_bad)))
                        .otherwise(F.array().cast("array<string>")))
    return per_loc.select(
        *keys, "months_present", "unrealistic_count",
        (F.size(errors) == 0).alias("is_valid"),
        errors.alias("errors"), warnings.alias("warnings"))


def profile_document(enriched: DataFrame, validation: DataFrame | None = None,
                     keys=LOCATION, year: int | None = None,
                     digits: int | None = 2) -> DataFrame:
    """One nested document per location: header, optional validation struct
    and the 12 month profiles as an array ordered by month."""
    def r(c):
        return F.round(F.col(c), digits) if digits is not None else F.col(c)

    month_struct = F.struct(
        F.col("month"),
        month_name_fr("month").alias("month_name"),
        F.struct(r("temp_mean").alias("mean"), r("temp_median").alias("median"),
                 r("temp_stddev").alias("stddev"), r("temp_min").alias("min"),
                 r("temp_max").alias("max"), r("temp_abs_min").alias("absolute_min"),
                 r("temp_abs_max").alias("absolute_max"), r("temp_q25").alias("q25"),
                 r("temp_q75").alias("q75"), r("temp_iqr").alias("iqr")).alias("temperature"),
        F.struct(r("wind_mean").alias("mean"), r("wind_median").alias("median"),
                 r("wind_stddev").alias("stddev"), r("windgust_mean").alias("gust_mean"),
                 r("wind_abs_min").alias("absolute_min"), r("wind_abs_max").alias("absolute_max"),
                 r("wind_q25").alias("q25"), r("wind_q75").alias("q75"),
                 r("wind_iqr").alias("iqr")).alias("wind"),
        F.struct(r("precipitation_mean").alias("mean"),
                 r("precipitation_stddev").alias("stddev"),
                 r("precipitation_max").alias("max")).alias("precipitation"),
        F.col("days_count"))
    docs = enriched.groupBy(*keys).agg(
        F.sort_array(F.collect_list(month_struct)).alias("profiles"))
    docs = docs.withColumns({
        "year": F.lit(None if year is None else str(year)).cast("string"),
        "generated_at": F.current_timestamp()})
    if validation is not None:
        v = validation.select(*keys, F.struct("is_valid", "errors", "warnings").alias("validation"))
        docs = docs.join(v, list(keys), "left")
    return docs


def explode_profiles(docs: DataFrame, keys=LOCATION) -> DataFrame:
    """Profile documents back to one row per (location, month); the
    validation verdict (when present) is repeated on every month row."""
    extra = [F.col("validation.is_valid").alias("is_valid")] \
        if "validation" in docs.columns else []
    return docs.select(*keys, *extra, F.explode("profiles").alias("p")).select(
        *keys, *(["is_valid"] if extra else []), "p.month", "p.month_name",
        F.col("p.temperature.mean").alias("temp_mean"),
        F.col("p.temperature.stddev").alias("temp_stddev"),
        F.col("p.temperature.median").alias("temp_median"),
        F.col("p.temperature.iqr").alias("temp_iqr"),
        F.col("p.wind.mean").alias("wind_mean"),
        F.col("p.wind.stddev").alias("wind_stddev"),
        F.col("p.wind.iqr").alias("wind_iqr"),
        F.col("p.precipitation.max").alias("precipitation_max"),
        "p.days_count")
