"""Landed API payloads -> rows.

* Archive payloads hold one location-year as parallel arrays under
  ``daily``; ``explode_archive`` zips them and emits one row per day (several
  payloads per location are simply more rows: the union of the yearly pulls).
* Current-weather payloads nest the measures under ``weather_data.current``;
  ``flatten_current`` produces flat observation rows and drops payloads
  without a ``current`` block.
* Geocoding responses list candidate places; ``resolve_locations`` keeps,
  per request, the first candidate in the requested country, else the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Archive API array fields and the daily column each one fills.
ARCHIVE_FIELDS = [
    ("time", "date"),
    ("temperature_2m_max", "temp_max"),
    ("temperature_2m_min", "temp_min"),
    ("temperature_2m_mean", "temp_mean"),
    ("precipitation_sum", "precipitation"),
    ("rain_sum", "rain"),
    ("snowfall_sum", "snowfall"),
    ("windspeed_10m_max", "windspeed_max"),
    ("windgusts_10m_max", "windgusts_max"),
    ("weathercode", "weather_code"),
]
HEADER = ["city", "country", "latitude", "longitude"]


def explode_archive(payloads: DataFrame, start: str | None = None,
                    end: str | None = None) -> DataFrame:
    """Parallel arrays -> one row per day (``date`` typed, bad dates null).

    ``start`` / ``end`` (inclusive ISO dates) keep an explicit period, e.g.
    exactly ten years, whatever the pulled payloads cover."""
    zipped = F.arrays_zip(*[F.col(f"daily.{src}").alias(src) for src, _ in ARCHIVE_FIELDS])
    rows = payloads.select(*HEADER, F.explode(zipped).alias("d"))
    cols = [F.col(f"d.{src}").alias(dst) for src, dst in ARCHIVE_FIELDS]
    out = rows.select(*HEADER, *cols).withColumn("date", F.col("date").try_cast("date"))
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("date") <= F.lit(end).cast("date"))
    return out.select("date", *HEADER, *[dst for _, dst in ARCHIVE_FIELDS[1:]])


def pack_archive(daily: DataFrame) -> DataFrame:
    """Inverse of ``explode_archive``: one payload per location and year.

    Rows are first made unique per (location, date), so each group holds at
    most one row per calendar day (366) and the sorted ``collect_list`` is
    bounded whatever the data volume.  Of conflicting rows for a day the least
    one (by its measures in the order of ``ARCHIVE_FIELDS``, null first)
    stays; ``archive_conflicts`` counts them.
    """
    keys, values = [*HEADER, "date"], [dst for _, dst in ARCHIVE_FIELDS if dst != "date"]
    daily = daily.groupBy(*keys).agg(F.min(F.struct(*values)).alias("least")).select(*keys, "least.*")
    day = F.struct(*[F.col(dst).alias(src) if dst != "date"
                     else F.col("date").cast("string").alias("time")
                     for src, dst in ARCHIVE_FIELDS])
    grouped = (daily.groupBy(*HEADER, F.year("date").alias("year"))
               .agg(F.sort_array(F.collect_list(day)).alias("days")))
    def field(name):
        return lambda x: x[name]
    arrays = F.struct(*[F.transform("days", field(src)).alias(src)
                        for src, _ in ARCHIVE_FIELDS])
    return grouped.select(*HEADER, "year", arrays.alias("daily"))


def archive_conflicts(daily: DataFrame) -> DataFrame:
    """Days that ``daily`` holds with different measures: the location, the
    date, ``n_rows`` and ``n_versions`` (distinct rows, one of which
    ``pack_archive`` keeps)."""
    keys, values = [*HEADER, "date"], [dst for _, dst in ARCHIVE_FIELDS if dst != "date"]
    versions = daily.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("n"))
    return (versions.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_versions"))
            .filter("n_versions > 1"))


# Current-weather API fields and the observation column each one fills.
CURRENT_FIELDS = [
    ("temperature_2m", "temperature"),
    ("wind_speed_10m", "windspeed"),
    ("wind_direction_10m", "wind_direction"),
    ("weather_code", "weather_code"),
    ("relative_humidity_2m", "humidity"),
    ("precipitation", "precipitation"),
]


def flatten_current(payloads: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    cur = "weather_data.current"
    return (payloads.filter(F.col(cur).isNotNull())
            .select("timestamp", "city", "latitude", "longitude", *extra,
                    *[F.col(f"{cur}.{src}").alias(dst) for src, dst in CURRENT_FIELDS],
                    F.col("weather_data.current_units").alias("units")))


CANDIDATE_FIELDS = ["name", "country", "country_code", "latitude", "longitude",
                    "admin1", "population"]


def candidates_from_payloads(payloads: DataFrame) -> DataFrame:
    """Geocoding responses (``query_name, query_country, results[]``) ->
    one row per (request, candidate position)."""
    return (payloads.select("query_name", "query_country",
                            F.posexplode("results").alias("pos", "c"))
            .select("query_name", "query_country", "pos", "c.*"))


def resolve_locations(candidates: DataFrame) -> DataFrame:
    """Per request: the first candidate whose ``country_code`` equals the
    requested code (case-insensitive request), else the first candidate.
    A plain grouped ``min_by`` — no sort, partial aggregation before the
    shuffle."""
    want = F.upper(F.col("query_country"))
    mismatch = F.when(F.col("country_code") == want, 0).otherwise(1)
    best = F.min_by(F.struct(*CANDIDATE_FIELDS), F.struct(mismatch, F.col("pos")))
    return (candidates.groupBy("query_name", "query_country").agg(best.alias("b"))
            .select("query_name", "query_country", "b.*",
                    F.coalesce(F.col("b.country_code") == F.upper(F.col("query_country")),
                               F.lit(False)).alias("code_matched")))


def resolve_against_gazetteer(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Requests (``query_name, query_country``) resolved against a shared
    candidate table (``name, pos, country_code, ...``).

    Same rule as ``resolve_locations`` without pairing every request with
    every candidate of its name: the candidates are reduced to the first
    one per name and the first one per (name, code) — two grouped
    ``min_by`` — and each request then joins at most one row of each.
    """
    payload = F.struct(*CANDIDATE_FIELDS)
    first_any = (candidates.groupBy(F.col("name").alias("_n"))
                 .agg(F.min_by(payload, "pos").alias("_any")))
    first_code = (candidates.groupBy(F.col("name").alias("_n"),
                                     F.col("country_code").alias("_c"))
                  .agg(F.min_by(payload, "pos").alias("_hit")))
    want = F.upper(F.col("query_country"))
    r = requests.select("query_name", "query_country")
    out = (r.join(first_code, (r.query_name == first_code._n) & (want == first_code._c), "left")
           .drop("_n", "_c")
           .join(first_any, r.query_name == first_any._n, "left"))
    best = F.coalesce("_hit", "_any")
    return out.select("query_name", "query_country",
                      *[best[f].alias(f) for f in CANDIDATE_FIELDS],
                      F.col("_hit").isNotNull().alias("code_matched"))
