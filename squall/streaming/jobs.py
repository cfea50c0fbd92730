"""The streaming jobs: classification, window aggregates, anomaly
detection, and the per-location store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from squall.folders import delete, mark, names
from squall.functions.classify import with_alert_levels
from squall.functions.parsing import with_defaults
from squall.operators import anomalies as A
from squall.operators import windows as W
from squall.session import scratch_path
from squall.sinks.files import write_location_store
from squall.streaming import sinks as S
from squall.streaming.sources import event_time_to_timestamp


def classify_stream(observations: DataFrame, defaults: bool = False) -> DataFrame:
    """Parsed observations -> classified observations (stateless map).

    ``defaults=True`` first fills missing fields (names ``Unknown``, numbers
    0), so a missing wind or temperature is classified ``level_0`` instead
    of ``unknown``, as the plain consumer loop did."""
    if defaults:
        observations = with_defaults(observations)
    return with_alert_levels(observations)


def window_stream(classified: DataFrame, kind: str, size: str = W.DEFAULT_SIZE,
                  slide: str = W.DEFAULT_SLIDE, watermark: str = W.DEFAULT_WATERMARK,
                  ts_col: str = "event_time") -> DataFrame:
    """One of the four sliding-window aggregates behind a watermark."""
    df = event_time_to_timestamp(classified, ts_col)
    return W.WINDOW_AGGREGATES[kind](df, ts_col, size, slide, watermark)


def start_window_queries(classified: DataFrame, sink, size: str = W.DEFAULT_SIZE,
                         slide: str = W.DEFAULT_SLIDE) -> dict[str, StreamingQuery]:
    """The four aggregates as named concurrent queries in update mode;
    ``sink(df, name)`` starts each one (console, table, ...)."""
    return {kind: sink(window_stream(classified, kind, size, slide), f"window_{kind}")
            for kind in W.WINDOW_AGGREGATES}


def start_window_queries_single_read(classified: DataFrame, writers: dict, checkpoint: str,
                                     size: str = W.DEFAULT_SIZE, slide: str = W.DEFAULT_SLIDE,
                                     watermark: str = W.DEFAULT_WATERMARK,
                                     ts_col: str = "event_time",
                                     query_name: str = "window_aggregates",
                                     available_now: bool = False,
                                     processing_time: str | None = None) -> StreamingQuery:
    """The four window aggregates from one read and one state store (update
    mode).  ``writers[kind](df, epoch_id)`` receives each micro-batch's rows
    of that aggregate; the batch is cached once for the four writers."""
    df = event_time_to_timestamp(classified, ts_col)
    combined = W.window_all_sets(df, ts_col, size, slide, watermark)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        for kind, part in W.split_window_sets(batch).items():
            if kind in writers:
                writers[kind](part, epoch_id)

    writer = (combined.writeStream.outputMode("update").foreachBatch(S.fan_out(write_batch))
              .option("checkpointLocation", checkpoint).queryName(query_name))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def anomaly_batch_writer(profile_path: str, out_path: str, ts_col: str = "event_time",
                         digits: int | None = None, kafka_servers: str | None = None,
                         kafka_topic: str = "weather_anomalies"):
    """``foreachBatch`` function: each micro-batch re-reads the profile table
    (a refreshed profile is used without restarting the stream), tags the
    batch and appends the anomalies to ``out_path/_epoch=N`` (idempotent);
    with ``kafka_servers`` the same rows are also published as JSON."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        profile = spark.read.parquet(profile_path)
        base = A.baseline(profile, digits=digits)
        found = A.detect_anomalies(batch, base, ts_col).persist()
        try:
            # the epoch's own folder: a retry with fewer or no rows replaces it
            found.write.mode("overwrite").parquet(f"{out_path}/_epoch={epoch_id}")
            if kafka_servers:
                S.batch_to_kafka(found, kafka_servers, kafka_topic)
        finally:
            found.unpersist()
    return write_batch


def publish_profile(profile: DataFrame, root: str) -> int:
    """Write the profile as the next version under ``root``; returns it.
    Versions are never changed, so what an epoch has used stays readable."""
    spark = profile.sparkSession
    version = 1 + max((int(n.removeprefix("v=")) for n in names(spark, root) if n.startswith("v=")), default=0)
    profile.write.parquet(f"{root}/v={version}")
    return version


def profile_version(spark: SparkSession, root: str, used: str, epoch_id: int) -> int:
    """The profile version of an epoch: the one noted when the epoch was
    first tried, else the newest whole one, which is noted.  A retry thus
    uses the same profile even if a newer one was published meanwhile."""
    noted = dict(map(int, n.split("_")) for n in names(spark, used))
    if epoch_id not in noted:
        whole = [int(n.removeprefix("v=")) for n in names(spark, root)
                 if n.startswith("v=") and "_SUCCESS" in names(spark, f"{root}/{n}")]
        if not whole:
            raise FileNotFoundError(f"no profile under {root}")
        noted[epoch_id] = max(whole)
        mark(spark, f"{used}/{epoch_id:012d}_{noted[epoch_id]}")
        # epochs before the last one are committed and never tried again
        for old, version in noted.items():
            if old < epoch_id - 1:
                delete(spark, f"{used}/{old:012d}_{version}")
    return noted[epoch_id]


def versioned_anomaly_writer(profile_root: str, base_dir: str, ts_col: str = "event_time", digits: int | None = None):
    """``foreachBatch`` function like ``anomaly_batch_writer`` over the
    versions of ``publish_profile``; rows carry the version they were checked
    against (``profile_version``)."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        version = profile_version(spark, profile_root, f"{base_dir}/used", epoch_id)
        base = A.baseline(spark.read.parquet(f"{profile_root}/v={version}"), digits=digits)
        found = A.detect_anomalies(batch, base, ts_col).withColumn("profile_version", F.lit(version))
        found.write.mode("overwrite").parquet(f"{base_dir}/data/_epoch={epoch_id}")
    return write_batch


def run_anomaly_stream(observations: DataFrame, profile_path: str, base_dir: str,
                       available_now: bool = True) -> str:
    out = f"{base_dir}/data"
    writer = (observations.writeStream
              .foreachBatch(anomaly_batch_writer(profile_path, out))
              .option("checkpointLocation", f"{base_dir}/checkpoint"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return out


def store_batch_writer(store_path: str):
    """``foreachBatch`` function: each micro-batch goes to its own
    ``store_path/_epoch=N``, rebalanced by location (about one file per
    location and batch, a hot one split); a retry replaces the folder whole."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        write_location_store(batch, f"{store_path}/_epoch={epoch_id}", mode="overwrite",
                             partition_overwrite="static")
    return write_batch


def store_stream(classified: DataFrame, name: str = "alert_store") -> str:
    """Classified stream -> per-location JSON Lines store, run to its end."""
    base = scratch_path(classified.sparkSession, f"stream-{name}")
    q = (classified.writeStream.foreachBatch(store_batch_writer(f"{base}/data"))
         .option("checkpointLocation", f"{base}/checkpoint")
         .queryName(f"{name}_{base[-12:]}").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{base}/data"

