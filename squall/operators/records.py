"""Climate records per location: rolling 30-day rain, arg-max / arg-min
days, and whole-period statistics.

The rolling sum is a window over bounded ranges of a location's history, each
with the rows before it that its first rows need; the records are ``max_by`` /
``min_by`` aggregates with partial aggregation, so a location holding a third
of all rows is spread in both steps and no top-1 sorts the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.operators.joins import materialize

LOCATION = ("country", "city")


SPAN_DAYS = 366       # calendar days of a location that are numbered together
RANGE_ROWS = 4096     # rows of a location that are summed together


def _same(a: DataFrame, b: DataFrame, keys) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _with_places(df: DataFrame, keys, order_col: str, span_days: int) -> DataFrame:
    """``df`` with ``_no``, each row's number (from 0) in its location, from
    the counts of the calendar spans before its own."""
    df = df.withColumn("_span", F.coalesce(F.floor(F.unix_date(order_col) / span_days), F.lit(-(2 ** 31))))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = df.groupBy(*keys, "_span").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy(*keys, "_span").orderBy(order_col)
    df = df.withColumn("_no", F.row_number().over(own) - 1)
    return (df.join(spans, _same(df, spans, [*keys, "_span"]))
            .select(*[df[c] for c in df.columns if c not in ("_span", "_no")],
                    (df["_no"] + F.col("_before")).alias("_no")))


def rolling_sum(df: DataFrame, value_col: str = "precipitation", n: int = 30,
                out_col: str = "rain_30days", keys=LOCATION, order_col: str = "date",
                mode: str = "rows", span_days: int = SPAN_DAYS,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """Sum of ``value_col`` over the last ``n`` rows (``mode="rows"``) or the
    last ``n`` calendar days (``mode="range"``, gaps in dates respected),
    ending at the current row; the first rows of a location are partial.

    A location's history is cut into ranges that are summed apart, each with
    the rows before it that its first rows still need (``n`` - 1 rows, or the
    rows of ``n`` - 1 days), so one long history spreads over many tasks.
    Numbering the rows reads ``df`` twice, so it is materialised first."""
    cols = df.columns
    halo = F.array("_range", F.col("_range") + 1)
    if mode == "rows":
        size = max(range_rows, n)
        df = _with_places(materialize(df), keys, order_col, span_days)
        df = df.withColumn("_range", F.expr(f"_no div {size}"))
        needed = F.col("_no") % size >= size - (n - 1)
        own = F.expr(f"_no div {size}")
        order, frame = "_no", lambda w: w.rowsBetween(-(n - 1), 0)
    elif mode == "range":
        size = max(span_days, n)
        day = F.unix_date(order_col)
        df = df.withColumn("_no", day).withColumn("_range", F.coalesce(F.floor(day / size), F.lit(-(2 ** 31))))
        needed = F.coalesce(F.pmod(day, F.lit(size)) >= size - (n - 1), F.lit(False))
        own = F.coalesce(F.floor(F.col("_no") / size), F.lit(-(2 ** 31)))
        order, frame = "_no", lambda w: w.rangeBetween(-(n - 1), 0)
    else:
        raise ValueError(f"mode must be 'rows' or 'range', not {mode!r}")
    df = df.withColumn("_at", F.explode(F.when(needed, halo).otherwise(F.array("_range"))))
    w = frame(Window.partitionBy(*keys, "_at").orderBy(order))
    return df.withColumn(out_col, F.sum(value_col).over(w)).filter(F.col("_at") == own).select(
        *[c for c in cols if c != out_col], out_col)


def _rank_key(measure: str, date_col: str, largest: bool) -> Column:
    """Ordering for max_by/min_by: the measure, ties to the earliest date.
    Null when the measure is null, so such rows never win."""
    d = F.unix_date(F.col(date_col))
    key = F.struct(F.col(measure), -d if largest else d)
    return F.when(F.col(measure).isNotNull(), key)


def arg_best(measure: str, fields: list[str], largest: bool = True,
             date_col: str = "date") -> Column:
    """The row (as a struct of ``fields``) with the largest/smallest measure."""
    payload = F.struct(*[F.col(f) for f in fields])
    fn = F.max_by if largest else F.min_by
    return fn(payload, _rank_key(measure, date_col, largest))


def climate_records(daily: DataFrame, keys=LOCATION, rain_days: int = 30,
                    rain_mode: str = "rows") -> DataFrame:
    """One flat row of records and statistics per location."""
    df = rolling_sum(daily, "precipitation", rain_days, "rain_30days", keys, mode=rain_mode)
    rec = df.groupBy(*keys).agg(
        arg_best("temp_max", ["date", "temp_max", "temp_min"]).alias("hot"),
        arg_best("temp_min", ["date", "temp_max", "temp_min"], largest=False).alias("cold"),
        arg_best("windgusts_max", ["date", "windgusts_max", "windspeed_max"]).alias("wind"),
        arg_best("rain_30days", ["date", "rain_30days"]).alias("rain"),
        arg_best("snowfall", ["date", "snowfall"]).alias("snow"),
        F.max("temp_max").alias("absolute_max_temp"),
        F.min("temp_min").alias("absolute_min_temp"),
        F.max("windgusts_max").alias("absolute_max_wind"),
        F.sum("precipitation").alias("total_precipitation"),
        F.sum("snowfall").alias("total_snowfall"),
        F.count(F.lit(1)).alias("total_days"))
    return rec.select(
        *keys,
        F.col("hot.date").alias("hottest_date"),
        F.col("hot.temp_max").alias("hottest_temp_max"),
        F.col("hot.temp_min").alias("hottest_temp_min"),
        F.col("cold.date").alias("coldest_date"),
        F.col("cold.temp_max").alias("coldest_temp_max"),
        F.col("cold.temp_min").alias("coldest_temp_min"),
        F.col("wind.date").alias("windiest_date"),
        F.col("wind.windgusts_max").alias("windiest_gust"),
        F.col("wind.windspeed_max").alias("windiest_speed"),
        F.col("rain.date").alias("rainiest_date"),
        F.col("rain.rain_30days").alias("rain_30days"),
        F.col("snow.date").alias("snowiest_date"),
        F.col("snow.snowfall").alias("snowfall"),
        "absolute_max_temp", "absolute_min_temp", "absolute_max_wind",
        "total_precipitation", "total_snowfall", "total_days")


def _num(c: str) -> Column:
    """Plain digits, never an exponent: one to six decimals; null for a value
    that is not a number."""
    digits = F.col(c).try_cast("decimal(38,6)").cast("string")
    return F.regexp_replace(digits, "0{1,5}$", "")


def _described(text: str, c: str) -> Column:
    """The text with the value, null without one."""
    return F.when(_num(c).isNotNull(), F.format_string(text, _num(c)))


# The description texts.
def records_document(records: DataFrame, keys=LOCATION) -> DataFrame:
    """Nested records document (one per location) with text descriptions."""
    return records.select(
        *keys,
        F.struct(F.col("hottest_date").cast("string").alias("date"),
                 F.col("hottest_temp_max").alias("temp_max"),
                 F.col("hottest_temp_min").alias("temp_min"),
                 _described("Jour le plus chaud: %s°C", "hottest_temp_max")
                 .alias("description")).alias("hottest_day"),
        F.struct(F.col("coldest_date").cast("string").alias("date"),
                 F.col("coldest_temp_max").alias("temp_max"),
                 F.col("coldest_temp_min").alias("temp_min"),
                 _described("Jour le plus froid: %s°C", "coldest_temp_min")
                 .alias("description")).alias("coldest_day"),
        F.struct(F.col("windiest_date").cast("string").alias("date"),
                 F.col("windiest_gust").alias("windgusts_max"),
                 F.col("windiest_speed").alias("windspeed_max"),
                 _described("Rafale la plus forte: %s m/s", "windiest_gust")
                 .alias("description")).alias("windiest_day"),
        F.struct(F.col("rainiest_date").cast("string").alias("date"),
                 F.col("rain_30days"),
                 F.when(F.col("rain_30days").isNotNull(), F.format_string("Période la plus pluvieuse (30 jours): %.1f mm", F.col("rain_30days"))).alias("description"))
        .alias("rainiest_period"),
        F.struct(F.col("snowiest_date").cast("string").alias("date"),
                 F.col("snowfall"),
                 _described("Jour le plus neigeux: %s cm", "snowfall")
                 .alias("description")).alias("snowiest_day"),
        F.struct("absolute_max_temp", "absolute_min_temp", "absolute_max_wind",
                 "total_precipitation", "total_snowfall", "total_days")
        .alias("statistics"))
