"""Ingestion queries: JSON parse/serialise, tolerant timestamps, labels,
archive and current-weather payloads, location resolution, alert read-out."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from squall.functions.labels import month_name_fr, weather_label
from squall.functions.parsing import parse_json_column, reject_flag, tolerant_timestamp
from squall.operators import reports as RP
from squall.operators.joins import shared_table
from squall.plans.registry import ORACLES, register
from squall.plans.reports import WEATHER_LABEL_SQL
from squall.plans.speed import classified
from squall.plans.sqlviews import MONTH_NAME, ctes, with_views
from squall.schemas import (ARCHIVE_PAYLOAD, CLASSIFIED_OBSERVATION, FLAT_OBSERVATION,
                            NESTED_OBSERVATION, OBSERVATION)
from squall.session import scratch_path
from squall.sources import payloads as PL
from squall.sources.files import load_history, rejects_by_reason
from squall.sources.testviews import daily, locations, obs, read_table

OBS_FIELDS = ["city", "country", "latitude", "longitude", "temperature", "windspeed",
              "wind_direction", "weather_code", "humidity", "precipitation"]


@register("parse_event_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def parse_event_props(spark, sf_dir):
    """JSON ``props`` of the events parsed to typed columns."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return parse_json_column(ev, "k int", "props", keep=("event_id",))


@register("json_roundtrip", with_views(ctes("obs"), """
SELECT event_id, original_timestamp AS timestamp, city, country, latitude, longitude,
       temperature, windspeed, wind_direction, weather_code, humidity, precipitation
FROM obs"""))
def json_roundtrip(spark, sf_dir):
    """Observation -> JSON message -> typed columns (serialise, then parse)."""
    o = obs(spark, sf_dir)
    msg = o.select("event_id", F.to_json(F.struct(
        F.col("original_timestamp").alias("timestamp"), *OBS_FIELDS)).alias("value"))
    return parse_json_column(msg, OBSERVATION, keep=("event_id",))


@register("parse_json_obs", with_views(ctes("obs"), """
SELECT event_id, original_timestamp AS timestamp, city, country,
       upper(substr(country, 1, 2)) AS country_code, city AS region, latitude, longitude,
       temperature, windspeed, wind_direction, weather_code, humidity, precipitation,
       '°C' AS temperature_unit, 'km/h' AS wind_unit
FROM obs"""))
def parse_json_obs(spark, sf_dir):
    """Producer-shape messages (13 scalars and a ``units`` object) parsed
    with the flat observation schema and star-expanded."""
    o = obs(spark, sf_dir)
    units = F.create_map(F.lit("temperature_2m"), F.lit("°C"),
                         F.lit("wind_speed_10m"), F.lit("km/h"))
    msg = o.select("event_id", F.to_json(F.struct(
        F.col("original_timestamp").alias("timestamp"), "city", "country",
        F.upper(F.substring("country", 1, 2)).alias("country_code"),
        F.col("city").alias("region"), *OBS_FIELDS[2:], units.alias("units")))
        .alias("value"))
    parsed = parse_json_column(msg, FLAT_OBSERVATION, keep=("event_id",))
    return parsed.select("event_id", *[c for c in FLAT_OBSERVATION.fieldNames() if c != "units"],
                         F.col("units")["temperature_2m"].alias("temperature_unit"),
                         F.col("units")["wind_speed_10m"].alias("wind_unit"))


@register("parse_rejects", with_views(ctes("obs"), """
SELECT 'valid' AS status, count(*) AS n FROM obs
UNION ALL SELECT 'rejected' AS status, count(*) AS n FROM events"""))
def parse_rejects(spark, sf_dir):
    """Messages parsed with the observation schema, valid vs rejected.
    Observation messages parse; the events' ``props`` objects carry none of
    the expected fields and are routed to the rejected side."""
    o = obs(spark, sf_dir)
    good = o.select(F.to_json(F.struct(F.col("original_timestamp").alias("timestamp"),
                                       *OBS_FIELDS)).alias("value"))
    other = read_table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    parsed = parse_json_column(good.unionByName(other), OBSERVATION, raw_col="_raw")
    status = F.when(reject_flag(OBSERVATION.fieldNames()), "rejected").otherwise("valid")
    return parsed.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("parse_timestamps", with_views(ctes("obs"), """
SELECT event_id, event_time AS ts_iso, event_time AS ts_zulu,
       date_trunc('second', event_time) AS ts_spaced,
       CAST(NULL AS TIMESTAMP) AS ts_garbage, CAST(NULL AS TIMESTAMP) AS ts_empty
FROM obs"""))
def parse_timestamps(spark, sf_dir):
    """ISO with ``T``, with ``Z``, ``yyyy-MM-dd HH:mm:ss``, garbage, empty."""
    o = obs(spark, sf_dir)
    texts = o.select(
        "event_id",
        F.col("original_timestamp").alias("iso"),
        F.concat("original_timestamp", F.lit("Z")).alias("zulu"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("spaced"),
        F.concat(F.lit("t#"), F.col("event_id").cast("string")).alias("garbage"),
        F.lit("").alias("empty"))

    def parse(c):
        return tolerant_timestamp(c).cast("timestamp_ntz")
    return texts.select("event_id", parse("iso").alias("ts_iso"),
                        parse("zulu").alias("ts_zulu"), parse("spaced").alias("ts_spaced"),
                        parse("garbage").alias("ts_garbage"), parse("empty").alias("ts_empty"))


@register("label_codes", with_views(ctes("obs"), f"""
SELECT event_id, weather_code, {WEATHER_LABEL_SQL} AS weather_label,
       {MONTH_NAME.replace('CASE month', 'CASE CAST(month(event_time) AS INTEGER)')}
         AS month_name
FROM obs"""))
def label_codes(spark, sf_dir):
    """Weather-code labels and French month names."""
    return obs(spark, sf_dir).select(
        "event_id", "weather_code", weather_label("weather_code").alias("weather_label"),
        month_name_fr(F.month("event_time")).alias("month_name"))


DAILY_COLS = ["date", "city", "country", "latitude", "longitude", "temp_max", "temp_min",
              "temp_mean", "precipitation", "rain", "snowfall", "windspeed_max",
              "windgusts_max", "weather_code"]


@register("archive_explode", with_views(ctes("daily"), "SELECT * FROM daily"))
def archive_explode(spark, sf_dir):
    """Daily rows packed into yearly archive payloads (JSON text), parsed
    and exploded back: the ingestion path of the history."""
    payload_text = PL.pack_archive(daily(spark, sf_dir)).select(
        F.to_json(F.struct(*PL.HEADER, "daily")).alias("value"))
    parsed = parse_json_column(payload_text, ARCHIVE_PAYLOAD)
    return PL.explode_archive(parsed).select(*DAILY_COLS)


@register("history_rejects", with_views(ctes("daily", extra=["d AS (SELECT day(date) AS d FROM daily)"]), """
SELECT 'valid' AS outcome, count(*) AS n FROM d WHERE d NOT IN (7, 14, 21, 22)
UNION ALL SELECT 'malformed', count(*) FROM d WHERE d IN (7, 14)
UNION ALL SELECT 'bad_date', count(*) FROM d WHERE d IN (21, 22)
UNION ALL SELECT 'duplicate_day', count(*) FROM d WHERE d = 28"""))
def history_rejects(spark, sf_dir):
    """History lines, some of them damaged (cut off, a text for a number, no
    date, a date that is none, a day twice), read into valid rows and rejects
    that are written beside them and counted by reason."""
    day = F.dayofmonth("date")
    date = F.when(day == 22, "soon").when(day != 21, F.col("date").cast("string"))
    line = F.to_json(F.struct(date.alias("date"), *DAILY_COLS[1:]))
    hot = F.regexp_replace(line, '"temp_max":[^,]*', '"temp_max":"hot"')
    rows = daily(spark, sf_dir).select(day.alias("day"), F.when(day == 14, hot).otherwise(line).alias("line"))
    line = F.when(F.col("day") == 7, F.expr("left(line, length(line) - 5)")).otherwise(F.col("line"))
    rows = rows.select(line.alias("line"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("day") == 28, 2).otherwise(1))))
    base = scratch_path(spark, "history")
    rows.select("line").write.text(f"{base}/lines")
    valid = load_history(spark, f"{base}/lines", f"{base}/rejects")
    return valid.agg(F.lit("valid").alias("outcome"), F.count(F.lit(1)).alias("n")).unionByName(
        rejects_by_reason(spark, f"{base}/rejects").withColumnRenamed("reason", "outcome"))


# Units block attached to current-weather payloads.
CURRENT_UNITS = {"temperature_2m": "°C", "wind_speed_10m": "km/h",
                 "relative_humidity_2m": "%", "precipitation": "mm"}


@register("nested_ingest", with_views(ctes("obs"), """
SELECT event_id, original_timestamp AS timestamp, city, latitude, longitude, temperature,
       windspeed, wind_direction, weather_code, humidity, precipitation,
       '°C' AS temperature_unit
FROM obs"""))
def nested_ingest(spark, sf_dir):
    """Observations as nested current-weather payloads -> flat rows."""
    o = obs(spark, sf_dir)
    units = F.create_map(*[F.lit(x) for kv in CURRENT_UNITS.items() for x in kv])
    current = F.struct(*[F.col(dst).alias(src) for src, dst in PL.CURRENT_FIELDS])
    payload = F.struct(F.col("original_timestamp").alias("timestamp"), "latitude",
                       "longitude", "city",
                       F.struct(current.alias("current"),
                                units.alias("current_units")).alias("weather_data"),
                       F.col("event_id"))
    text = o.select(F.to_json(payload).alias("value"))
    schema = StructType(NESTED_OBSERVATION.fields + [StructField("event_id", LongType())])
    flat = PL.flatten_current(parse_json_column(text, schema), extra=("event_id",))
    return flat.select("event_id", "timestamp", "city", "latitude", "longitude",
                       "temperature", "windspeed", "wind_direction", "weather_code",
                       "humidity", "precipitation",
                       F.col("units")["temperature_2m"].alias("temperature_unit"))


def _candidates(spark, sf_dir):
    """Candidate places per searched name: every nation is a candidate for
    its region's name (position = nation key, code ``N<key>``)."""
    loc = locations(spark, sf_dir)
    return loc.select(F.col("country").alias("name"), F.col("loc_id").alias("pos"),
                      F.col("city").alias("country"),
                      F.concat(F.lit("N"), F.col("loc_id").cast("string")).alias("country_code"),
                      "latitude", "longitude", F.col("country").alias("admin1"),
                      (F.col("loc_id") * 1000).alias("population"))


def _resolve(requests, cands):
    """Per-request choice against the shared candidate table (no pairing of
    requests with all candidates of a name)."""
    return PL.resolve_against_gazetteer(requests, cands)


RESOLVE_SQL_CTES = [
    "cand AS (SELECT country AS name, loc_id AS pos, city AS country, 'N' || loc_id AS "
    "country_code, latitude, longitude, country AS admin1, loc_id * 1000 AS population "
    "FROM loc)"]


@register("resolve_location", with_views(ctes("loc", extra=RESOLVE_SQL_CTES + [
    "req AS (SELECT DISTINCT l.country AS query_name, 'N' || (c.c_custkey % 30) AS "
    "query_country FROM customer c JOIN loc l ON CAST(c.c_nationkey AS BIGINT) = l.loc_id)",
    "ranked AS (SELECT req.*, cand.*, row_number() OVER (PARTITION BY query_name, "
    "query_country ORDER BY (cand.country_code = req.query_country) DESC, pos) AS rn "
    "FROM req JOIN cand ON cand.name = req.query_name)"]), """
SELECT query_name, query_country, name, country, country_code, latitude, longitude, admin1,
       population, country_code = query_country AS code_matched
FROM ranked WHERE rn = 1"""))
def resolve_location(spark, sf_dir):
    """Geocoding choice for every distinct (region name, requested code) seen
    in the customer table; codes N25..N29 exist nowhere and fall back."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    loc = locations(spark, sf_dir)
    req = (cust.join(loc, F.col("c_nationkey").cast("bigint") == loc.loc_id)
           .select(F.col("country").alias("query_name"),
                   F.concat(F.lit("N"), (F.col("c_custkey") % 30).cast("string"))
                   .alias("query_country"))
           .distinct())
    return _resolve(req, _candidates(spark, sf_dir))


@register("geo_enriched_obs", with_views(ctes("obs", extra=RESOLVE_SQL_CTES + [
    "req AS (SELECT DISTINCT country AS query_name, 'N' || CAST(latitude AS INTEGER) AS "
    "query_country FROM obs)",
    "ranked AS (SELECT req.*, cand.*, row_number() OVER (PARTITION BY query_name, "
    "query_country ORDER BY (cand.country_code = req.query_country) DESC, pos) AS rn "
    "FROM req JOIN cand ON cand.name = req.query_name)",
    "res AS (SELECT * FROM ranked WHERE rn = 1)"]), """
SELECT o.event_id, o.city, o.country, res.country_code, res.admin1 AS region, res.population
FROM obs o JOIN res ON res.query_name = o.country
 AND res.query_country = 'N' || CAST(o.latitude AS INTEGER)"""))
def geo_enriched_obs(spark, sf_dir):
    """Observations joined to their resolved location (country code,
    region, population): the geocoding cache — one resolution per known
    location, taken from the location dimension — as a dimension join, so
    the observations are scanned once."""
    o = obs(spark, sf_dir).withColumn(
        "query_country", F.concat(F.lit("N"), F.col("latitude").cast("int").cast("string")))
    req = locations(spark, sf_dir).select(
        F.col("country").alias("query_name"),
        F.concat(F.lit("N"), F.col("loc_id").cast("string")).alias("query_country"))
    res = _resolve(req, _candidates(spark, sf_dir)).select(
        "query_name", "query_country", "country_code", F.col("admin1").alias("region"),
        "population")
    res = shared_table(res, "resolved").alias("r")
    return (o.alias("o")
            .join(res, (F.col("o.country") == F.col("r.query_name"))
                  & (F.col("o.query_country") == F.col("r.query_country")))
            .select("o.event_id", "o.city", "o.country", "r.country_code", "r.region",
                    "r.population"))


@register("alert_feed", with_views(ctes("cobs"), """
SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time_text, city, country,
       temperature, windspeed, heat_alert_level, wind_alert_level,
       (heat_alert_level = 'level_2' OR wind_alert_level = 'level_2') AS is_critical
FROM cobs"""))
def alert_feed(spark, sf_dir):
    """Classified messages read back: tolerant time parse, field defaults,
    level-2 highlight."""
    return alert_feed_of(classified(spark, sf_dir))


ALERT_FEED_SQL = ORACLES["alert_feed"]


def alert_feed_of(c):
    """The alert read-out over classified rows (batch or stream): rows are
    serialised as messages, parsed back and read out."""
    msgs = c.select(F.to_json(F.struct(
        F.col("original_timestamp").alias("event_time"), "original_timestamp", *OBS_FIELDS,
        "wind_alert_level", "heat_alert_level")).alias("value"))
    return RP.alert_feed(parse_json_column(msgs, CLASSIFIED_OBSERVATION))
