"""Long-running deployments of the speed layer on Kafka.

Each function starts the streaming queries of one job and returns them;
the caller waits with ``spark.streams.awaitAnyTermination()`` so that a
failure of any query (not only the first one) stops the application.
Checkpoints go to ``<checkpoint_root>/<query>``, which must be on a shared
file system.  The Kafka connector must be on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from squall.functions.classify import with_alert_levels
from squall.functions.parsing import (parse_json_column, reject_reason, split_rejects,
                                      tolerant_timestamp)
from squall.operators import anomalies as A
from squall.operators import reports as RP
from squall.operators import windows as W
from squall.schemas import ANOMALY_EVENT, CLASSIFIED_OBSERVATION, FLAT_OBSERVATION
from squall.streaming import jobs as J
from squall.streaming import metrics as M
from squall.streaming import sinks as S
from squall.streaming.sources import kafka_json_stream, kafka_stream

# Topic names of the deployment.
TOPIC_OBSERVATIONS = "weather_stream"
TOPIC_CLASSIFIED = "weather_transformed"
TOPIC_ANOMALIES = "weather_anomalies"


def classified_from_observations(obs: DataFrame, event_time_col: str = "timestamp",
                                 processing_time: bool = True) -> DataFrame:
    """Observation messages -> classified observations.  ``event_time`` is
    the observation's own time (parsed tolerantly); the processing time is
    kept separately as ``processed_at``."""
    out = with_alert_levels(obs).withColumns({
        "original_timestamp": F.col(event_time_col),
        "event_time": tolerant_timestamp(event_time_col)})
    if processing_time:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out.drop(event_time_col)


def classification_batch_writer(publish, console: bool = False,
                                rejects_path: str | None = None,
                                metrics_path: str | None = None):
    """``foreachBatch`` function for parsed observation messages (with their
    raw text in ``_raw``): valid rows are classified and handed to
    ``publish(df)`` (the topic writer) and optionally printed; rejected ones
    — raw text and a reason — go to ``rejects_path/_epoch=N`` instead of
    vanishing as all-null rows.  With a ``_bad`` column (see
    ``parse_json_column``) values of the wrong type and messages without a
    time are rejected too.  ``metrics_path`` gets one row of counts per epoch
    (see ``streaming.metrics``)."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        bad = "_bad" if "_bad" in batch.columns else None
        rule = {"time_col": "timestamp", "bad_col": bad, "require_time": bad is not None}
        if metrics_path:
            M.write_epoch(M.counted(batch, reject_reason(FLAT_OBSERVATION.fieldNames(), **rule)), metrics_path, epoch_id)
        valid, rejected = split_rejects(batch, FLAT_OBSERVATION.fieldNames(), **rule)
        out = classified_from_observations(valid).withColumn(
            "event_time", F.col("event_time").cast("string"))
        publish(out)
        if console:
            S.console_batch_writer()(out, epoch_id)
        if rejects_path:
            rejected.write.mode("overwrite").parquet(f"{rejects_path}/_epoch={epoch_id}")
    return S.fan_out(write_batch)


def start_classification(spark: SparkSession, servers: str, checkpoint_root: str,
                         console: bool = False,
                         rejects_path: str | None = None,
                         metrics_path: str | None = None) -> StreamingQuery:
    """weather_stream -> classify -> weather_transformed, one read of the
    topic per micro-batch (see ``classification_batch_writer``)."""
    raw = kafka_stream(spark, servers, TOPIC_OBSERVATIONS)
    parsed = parse_json_column(raw, FLAT_OBSERVATION, raw_col="_raw", bad_col="_bad")
    writer = classification_batch_writer(
        lambda df: S.batch_to_kafka(df, servers, TOPIC_CLASSIFIED), console, rejects_path, metrics_path)
    return (parsed.writeStream.foreachBatch(writer)
            .option("checkpointLocation", f"{checkpoint_root}/classify")
            .queryName("classify").start())


def classified_stream(spark: SparkSession, servers: str) -> DataFrame:
    """weather_transformed parsed back, event time as TIMESTAMP."""
    df = kafka_json_stream(spark, servers, TOPIC_CLASSIFIED, CLASSIFIED_OBSERVATION)
    return df.withColumn("event_time", tolerant_timestamp("event_time"))


def start_aggregates(spark: SparkSession, servers: str, checkpoint_root: str,
                     size: str = W.DEFAULT_SIZE, slide: str = W.DEFAULT_SLIDE,
                     trigger: str | None = None, single_read: bool = True):
    """The four window aggregates on the console in update mode.

    ``single_read`` (default) runs them as one query — one read of the topic,
    one grouping-sets state store — printing each aggregate per micro-batch;
    otherwise as four named queries, as the original job did."""
    src = classified_stream(spark, servers)
    if single_read:
        writers = {kind: _console_part(kind) for kind in W.WINDOW_AGGREGATES}
        q = J.start_window_queries_single_read(src, writers, f"{checkpoint_root}/windows",
                                               size, slide, processing_time=trigger)
        return {"all": q}

    def sink(df, name):
        return S.to_console(df, mode="update", query_name=name,
                            checkpoint=f"{checkpoint_root}/{name}", processing_time=trigger)
    return J.start_window_queries(src, sink, size, slide)


def _console_part(kind: str):
    def write(part: DataFrame, epoch_id: int) -> None:
        print(f"-- {kind} (batch {epoch_id})")
        part.show(part.count(), truncate=False)
    return write


def start_anomalies(spark: SparkSession, servers: str, checkpoint_root: str,
                    profile_path: str, out_path: str, publish: bool = True) -> StreamingQuery:
    """weather_transformed vs the profile table (re-read every micro-batch):
    anomalies appended to ``out_path`` in ``_epoch`` partitions and, with
    ``publish``, sent to the weather_anomalies topic."""
    src = classified_stream(spark, servers)
    writer = J.anomaly_batch_writer(profile_path, out_path,
                                    kafka_servers=servers if publish else None,
                                    kafka_topic=TOPIC_ANOMALIES)
    return (src.writeStream
            .foreachBatch(writer)
            .option("checkpointLocation", f"{checkpoint_root}/anomalies")
            .queryName("anomalies").start())


def start_store(spark: SparkSession, servers: str, checkpoint_root: str, store_path: str,
                trigger: str = "1 minute") -> StreamingQuery:
    """weather_transformed -> JSON Lines store partitioned by location (see
    ``jobs.store_batch_writer``)."""
    return (classified_stream(spark, servers).writeStream
            .foreachBatch(J.store_batch_writer(store_path))
            .option("checkpointLocation", f"{checkpoint_root}/store")
            .trigger(processingTime=trigger).queryName("store").start())


def start_alert_monitor(spark: SparkSession, servers: str,
                        starting_offsets: str = "earliest") -> StreamingQuery:
    """Console read-out of weather_transformed (times parsed tolerantly,
    defaults for missing fields, level-2 rows flagged)."""
    df = kafka_json_stream(spark, servers, TOPIC_CLASSIFIED, CLASSIFIED_OBSERVATION,
                           starting_offsets)
    return S.to_console(RP.alert_feed(df, fallback_now=True), query_name="alert_monitor")


def start_anomaly_monitor(spark: SparkSession, servers: str,
                          starting_offsets: str = "latest") -> StreamingQuery:
    """Console read-out of weather_anomalies (label, unit, percent gap)."""
    df = kafka_json_stream(spark, servers, TOPIC_ANOMALIES, ANOMALY_EVENT, starting_offsets)
    return S.to_console(A.anomaly_feed(df), query_name="anomaly_monitor")


class MessageCounter(StreamingQueryListener):
    """Rows consumed per query since the listener was added
    (``spark.streams.addListener``), over all progress reports: a query's own
    list of them is cut to the latest."""

    def __init__(self):
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.counts.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        self.counts[name] = self.counts.get(name, 0) + p.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_until_any_stops(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any query ends (or fails, re-raising its error) or the
    timeout passes, then stop the remaining queries one by one.  Spark
    remembers terminations since the last ``spark.streams.resetTerminated()``,
    so call that before starting the queries of a new run."""
    try:
        if timeout_s is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout_s)
    finally:
        for q in spark.streams.active:
            q.stop()


def drain_and_stop(query: StreamingQuery) -> None:
    """Process everything already available (the last partial micro-batch
    is written, nothing is left buffered), then stop the query."""
    query.processAllAvailable()
    query.stop()
