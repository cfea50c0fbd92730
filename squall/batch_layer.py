"""The batch layer as one job: daily history -> climate records, basic
monthly profiles and validated enriched profiles, written as documents
partitioned by location.

The history is read once and written as a Parquet snapshot in the shared
folder, so the three document sets are computed from the same rows without
re-reading the source, each reads only its columns, and a lost executor
recomputes from the snapshot; it is deleted at the end.  Writes use dynamic
partition overwrite: re-running for some locations (or one year) replaces
only their folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.operators import profiles as P
from squall.operators import records as R
from squall.operators.joins import materialize
from squall.session import snapshot
from squall.sinks.files import write_documents
from squall.sources.files import load_history


ALL_YEARS = "all"


def basic_profile_document(profile: DataFrame, keys=("country", "city"),
                           digits: int | None = 2) -> DataFrame:
    """Basic profile rows -> one document per location (months sorted)."""
    def r(c, d=digits):
        return F.round(F.col(c), d) if d is not None else F.col(c)
    month = F.struct(
        F.col("month"), P.month_name_fr("month").alias("month_name"),
        F.struct(r("temp_mean").alias("mean"), r("temp_max").alias("max"),
                 r("temp_min").alias("min"), r("temp_stddev").alias("stddev"),
                 r("temp_abs_min").alias("absolute_min"),
                 r("temp_abs_max").alias("absolute_max")).alias("temperature"),
        F.struct(r("wind_mean").alias("mean"), r("windgust_mean").alias("gust_mean"),
                 r("wind_stddev").alias("stddev"),
                 r("wind_abs_max").alias("absolute_max")).alias("wind"),
        F.struct(r("precipitation_mean").alias("mean"), r("rain_mean").alias("rain_mean"),
                 r("snowfall_mean").alias("snowfall_mean")).alias("precipitation"),
        F.struct(r("heat_alert_probability", 4 if digits is not None else None)
                 .alias("heat_probability"),
                 r("wind_alert_probability", 4 if digits is not None else None)
                 .alias("wind_probability")).alias("alerts"),
        F.col("days_count"))
    return (profile.groupBy(*keys).agg(F.sort_array(F.collect_list(month)).alias("profiles"))
            .withColumn("generated_at", F.current_timestamp()))


# Topic receiving the records documents.
TOPIC_RECORDS = "weather_records"


def run_batch_layer(spark: SparkSession, history: DataFrame | str, out_root: str,
                    year: int | None = None,
                    kafka_servers: str | None = None) -> dict[str, str]:
    """Compute and write the three document sets; returns their folders.
    History lines that cannot be used are written to ``rejects`` with their
    reason.  With ``kafka_servers`` the records documents are also published, one
    message per location (``timestamp``, ``city``, ``country``, ``records``)."""
    rejects = {"rejects": f"{out_root}/rejects"} if isinstance(history, str) else {}
    daily = load_history(spark, history, rejects["rejects"]) if rejects else history
    with snapshot(P.for_year(daily, year), "daily") as daily:
        return _write_documents(daily, out_root, year, kafka_servers) | rejects


def _write_documents(daily: DataFrame, out_root: str, year: int | None,
                     kafka_servers: str | None) -> dict[str, str]:
    out = {"records": f"{out_root}/records", "profiles": f"{out_root}/seasonal_profile",
           "enriched": f"{out_root}/seasonal_profile_enriched"}
    records = R.records_document(R.climate_records(daily))
    write_documents(records, out["records"])
    if kafka_servers:
        from squall.streaming.sinks import batch_to_kafka
        doc_cols = [c for c in records.columns if c not in ("country", "city")]
        msgs = records.select(F.date_format(F.current_timestamp(),
                                            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                              "city", "country", F.struct(*doc_cols).alias("records"))
        batch_to_kafka(msgs, kafka_servers, TOPIC_RECORDS)
    write_documents(basic_profile_document(P.seasonal_profile(daily)), out["profiles"])
    monthly = materialize(P.enriched_profile(daily, with_quality=True))
    enriched = P.profile_document(monthly, P.validation_from_monthly(monthly), year=year)
    # one layout for all runs: the whole-history run is filed under year=all
    enriched = enriched.withColumn("year", F.coalesce("year", F.lit(ALL_YEARS)))
    write_documents(enriched, out["enriched"], partition_cols=("country_dir", "city_dir", "year"))
    return out
