"""Observation (``obs``) and daily-history (``daily``) views over the
driver's star-schema tables.

The driver ships TPC-H-like tables, not weather feeds.  These two views map
them onto the package's record shapes so every registered query runs over
whole tables and grows with them:

* ``obs`` — one observation per ``events`` row.  The location is the nation
  ``user_id % 25`` (city = nation name, country = region name); temperature is
  ``value``, wind speed is the ``k`` field of the JSON ``props``.
* ``daily`` — one row per (location, order date) from ``orders`` joined to the
  customer's nation; ``lineitem`` is aggregated per order *before* it is joined
  (no fan-out), so the join is one-to-one on ``o_orderkey``.

Both views are plain DataFrames: Catalyst prunes the columns each query
needs and pushes filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.operators.profiles import for_year

# Fixed values of the mapping (shared with the SQL oracle text).
NATION_COUNT = 25            # events.user_id % 25 picks the nation
PRICE_TO_DEGREES = 10000.0   # o_totalprice / 10000 -> degrees
PRECIP_MOD, RAIN_MOD, CODE_MOD = 50, 20, 100


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Location dimension as its two tables, (places, countries).  Joined one
    after the other, each is planned by the size of its own files; Spark takes
    a join of both to be as large as their product."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return (nation.select(F.col("n_nationkey").cast("bigint").alias("loc_id"), F.col("n_name").alias("city"),
                          F.col("n_nationkey").cast("double").alias("latitude"),
                          F.col("n_regionkey").alias("region_key")),
            region.select(F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("country"),
                          F.col("r_regionkey").cast("double").alias("longitude")))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location dimension: nation joined to its region."""
    nation, region = places(spark, sf_dir)
    return nation.join(region, "region_key").select("loc_id", "city", "country", "latitude", "longitude")


def obs_from_events(events: DataFrame, loc: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Map ``events`` rows (batch or stream) to observations at ``places``."""
    k = F.from_json(F.col("props"), "k int").getField("k")
    e = events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        (F.col("user_id") % NATION_COUNT).alias("loc_id"),
        F.col("value").alias("temperature"),
        k.cast("double").alias("windspeed"),
        (k % 10).cast("int").alias("weather_code"),
        (F.col("event_id") % 360).cast("double").alias("wind_direction"),
        (F.col("user_id") % 101).cast("double").alias("humidity"),
        (F.col("event_id") % 7).cast("double").alias("precipitation"),
    )
    nation, region = loc
    return (e.join(nation, "loc_id").join(region, "region_key")
            .select("event_id", "event_time",
                    F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                    .alias("original_timestamp"),
                    "city", "country", "latitude", "longitude", "temperature",
                    "windspeed", "wind_direction", "weather_code", "humidity",
                    "precipitation"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat observations (event time is TIMESTAMP_NTZ, as stored)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    return obs_from_events(events, places(spark, sf_dir))


def order_weather(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Per-order wind and snow measures from lineitem (one row per order),
    of the given orders only if there are any given."""
    li = read_table(spark, sf_dir, "lineitem")
    if orders is not None:
        wanted = orders.select(F.col("o_orderkey").alias("l_orderkey"))
        li = li.join(wanted, "l_orderkey", "left_semi")
    return (li.groupBy("l_orderkey")
            .agg(F.max("l_quantity").alias("q_max"),
                 F.sum(F.when(F.col("l_returnflag") == "R",
                              F.col("l_quantity").cast("bigint")).otherwise(0))
                 .alias("snow")))


def daily(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Daily history rows (schema of the archive ingestion, ``date`` typed).
    With ``year`` only its orders are read, and only their lineitems are
    aggregated."""
    orders = for_year(read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), year, "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    loc = locations(spark, sf_dir)
    per_order = (orders
                 .join(customer, orders.o_custkey == customer.c_custkey)
                 .join(loc, F.col("c_nationkey").cast("bigint") == loc.loc_id)
                 .join(order_weather(spark, sf_dir, None if year is None else orders),
                       F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (per_order
            .groupBy("country", "city", "latitude", "longitude",
                     F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.max("o_totalprice") / PRICE_TO_DEGREES).alias("temp_max"),
                 (F.min("o_totalprice") / PRICE_TO_DEGREES).alias("temp_min"),
                 (F.sum(cents) / F.count(F.lit(1)) / (PRICE_TO_DEGREES * 100))
                 .alias("temp_mean"),
                 F.sum(F.col("o_custkey") % PRECIP_MOD).cast("double").alias("precipitation"),
                 F.sum(F.col("o_custkey") % RAIN_MOD).cast("double").alias("rain"),
                 F.sum("snow").cast("double").alias("snowfall"),
                 F.max("q_max").alias("windspeed_max"),
                 (F.max("q_max") * 2).alias("windgusts_max"),
                 F.min(F.col("o_orderkey") % CODE_MOD).cast("int").alias("weather_code"))
            .select("date", "city", "country", "latitude", "longitude", "temp_max",
                    "temp_min", "temp_mean", "precipitation", "rain", "snowfall",
                    "windspeed_max", "windgusts_max", "weather_code"))
