"""Streaming twins of the batch queries.

The ``events`` table is consumed as a file stream (a drop folder), mapped to
observations through a stream-static join with the location dimension, and
run to completion with ``availableNow``.  Results land in tables in the
shared folder (never in driver memory) and are read back as DataFrames, so
each streaming query is checked against the same SQL as its batch twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from squall.functions.parsing import parse_json_column
from squall.operators import profiles as P
from squall.operators import windows as W
from squall.operators.joins import materialize
from squall.plans import history, ingest, reports, speed
from squall.plans.registry import register
from squall.plans.sqlviews import COBS, HEAT_LEVEL, WIND_LEVEL, ctes, with_views
from squall.schemas import FLAT_OBSERVATION, OBSERVATION
from squall.session import scratch_path
from squall.sources.files import read_location_store
from squall.sources.testviews import daily, obs_from_events, places, read_table
from squall.streaming import jobs as J
from squall.streaming import sinks as S
from squall.streaming.apps import classification_batch_writer
from squall.streaming.keyed_flush import flush_by_key, start_flush
from squall.streaming.landing import replay, time_parts
from squall.streaming.metrics import read_metrics
from squall.streaming.sources import event_time_to_timestamp, file_stream
from squall.streaming.update_store import read_updates, update_writer


def obs_stream(spark, sf_dir, max_files_per_trigger=None):
    schema = read_table(spark, sf_dir, "events").schema
    events = file_stream(spark, sf_dir, schema, glob="events.parquet",
                         max_files_per_trigger=max_files_per_trigger)
    return obs_from_events(events, places(spark, sf_dir))


@register("stream_classify", speed.ORACLES_FOR_STREAMS["classify_obs"])
def stream_classify(spark, sf_dir):
    """Classification as an append-mode stream over the events drop folder."""
    path = S.run_append_to_table(J.classify_stream(obs_stream(spark, sf_dir)), "classify")
    return spark.read.parquet(path)


def _window_query(kind):
    def run(spark, sf_dir):
        agg = J.window_stream(J.classify_stream(obs_stream(spark, sf_dir)), kind)
        agg = agg.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                               "window_end": F.col("window_end").cast("timestamp_ntz")})
        path = S.run_updates_to_table(agg, f"window_{kind}")
        return S.latest_updates(spark, path, W.WINDOW_KEYS[kind])
    run.__name__ = f"stream_win_{kind}"
    run.__doc__ = f"Streaming sliding-window aggregate '{kind}' (update mode, watermark)."
    return run


for _kind in W.WINDOW_AGGREGATES:
    register(f"stream_win_{_kind}", speed.ORACLES_FOR_STREAMS[f"win_{_kind}"])(
        _window_query(_kind))


@register("stream_win_city_shared", speed.ORACLES_FOR_STREAMS["win_city"])
def stream_win_city_shared(spark, sf_dir):
    """City statistics taken from the single-read job that computes all four
    window aggregates with one stateful grouping-sets aggregate."""
    base = scratch_path(spark, "stream-window-shared")

    def city_writer(part, epoch_id):
        (part.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                           "window_end": F.col("window_end").cast("timestamp_ntz")})
         .write.mode("overwrite").parquet(f"{base}/city/_epoch={epoch_id}"))
    q = J.start_window_queries_single_read(
        J.classify_stream(obs_stream(spark, sf_dir)), {"city": city_writer},
        f"{base}/checkpoint", query_name=f"window_shared_{base[-12:]}", available_now=True)
    q.awaitTermination()
    return S.latest_updates(spark, f"{base}/city", W.WINDOW_KEYS["city"])


@register("stream_win_global_append", speed.ORACLES_FOR_STREAMS["win_global"].replace(
    "FROM wins GROUP BY window_start",
    "FROM wins GROUP BY window_start\nHAVING window_start + INTERVAL 5 MINUTE <= "
    "(SELECT max(event_time) FROM obs) - INTERVAL 10 MINUTE"))
def stream_win_global_append(spark, sf_dir):
    """Append mode: a window is emitted once the watermark (latest event
    time minus 10 minutes) has passed its end, so the last windows of the
    input stay open and are not emitted."""
    agg = J.window_stream(J.classify_stream(obs_stream(spark, sf_dir)), "global")
    agg = agg.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                           "window_end": F.col("window_end").cast("timestamp_ntz")})
    return spark.read.parquet(S.run_append_to_table(agg, "window_global_append"))


@register("stream_anomalies", history.ORACLES_FOR_STREAMS["anomalies"])
def stream_anomalies(spark, sf_dir):
    """Profiles computed in batch and written to a table; the observation
    stream is checked against it micro-batch by micro-batch."""
    profile_path = scratch_path(spark, "profile")
    P.seasonal_profile(daily(spark, sf_dir)).write.parquet(profile_path)
    base_dir = scratch_path(spark, "stream-anomalies")
    out = J.run_anomaly_stream(obs_stream(spark, sf_dir), profile_path, base_dir)
    return spark.read.parquet(out).drop("_epoch")


@register("stream_alert_feed", ingest.ALERT_FEED_SQL)
def stream_alert_feed(spark, sf_dir):
    """The alert read-out as a stateless stream (messages -> feed rows)."""
    feed = ingest.alert_feed_of(J.classify_stream(obs_stream(spark, sf_dir)))
    return spark.read.parquet(S.run_append_to_table(feed, "alert_feed"))


@register("stream_store", reports.ORACLES_FOR_STREAMS["store_audit"])
def stream_store(spark, sf_dir):
    """Classified stream appended to the per-location store, then audited."""
    path = J.store_stream(J.classify_stream(obs_stream(spark, sf_dir)))
    stored = read_location_store(spark, path, drop_malformed=False)
    return (stored.rollup("country_dir", "city_dir")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.count(F.lit(1)).alias("n_alerts")))


# --- several runs on one checkpoint -----------------------------------------

LANDINGS, LATE_LANDINGS, LATE_EVERY = 4, 5, 50


def _untimed(windows):
    """Window bounds without a zone, as the SQL has them."""
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _window_table(spark, sf_dir, name, kind, part, n, every=2):
    """The shared window job over events that land in ``n`` pieces, each read
    by a new run on the same checkpoint; returns the table of one output."""
    base = scratch_path(spark, name)
    events = read_table(spark, sf_dir, "events")
    loc, schemas = places(spark, sf_dir), []

    def write(rows, epoch_id):
        rows = _untimed(rows)
        schemas.append(rows.schema)
        update_writer(f"{base}/{kind}", W.WINDOW_KEYS[kind], rows.schema, every)(rows, epoch_id)

    def start():
        stream = obs_from_events(file_stream(spark, f"{base}/landed", events.schema), loc)
        return J.start_window_queries_single_read(J.classify_stream(stream), {kind: write}, f"{base}/checkpoint",
                                                  query_name=f"{name}_{base[-12:]}", available_now=True)
    replay(events, part(events), n, f"{base}/landed", start)
    return read_updates(spark, f"{base}/{kind}", W.WINDOW_KEYS[kind], schemas[0])


@register("stream_resumed_city", speed.ORACLES_FOR_STREAMS["win_city"])
def stream_resumed_city(spark, sf_dir):
    """City windows of a stateful stream that is stopped after each quarter of
    the events and started again on its checkpoint: state, watermark and
    offsets are recovered, so the table equals that of all events at once."""
    return _window_table(spark, sf_dir, "stream-resumed", "city", lambda e: time_parts(e, "ts", LANDINGS), LANDINGS)


_LATE = f"event_id % {LATE_EVERY} = 0 AND (epoch_us(event_time) - lo) * {LATE_LANDINGS} // (hi - lo + 1) < 2"
_KEPT_SQL = (",\nspan AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM obs),\n"
             f"kept AS (SELECT cobs.* FROM cobs, span WHERE NOT ({_LATE}))")


def _without_late(sql):
    return sql.replace("FROM cobs", "FROM kept").replace(COBS, COBS + _KEPT_SQL)


def _late_part(events):
    """Time order, but every 50th row of the first two fifths lands last."""
    part = time_parts(events, "ts", LATE_LANDINGS)
    late = (F.col("event_id") % LATE_EVERY == 0) & (part < 2)
    return F.when(late, LATE_LANDINGS - 1).otherwise(part)


def _late_query(kind):
    def run(spark, sf_dir):
        return _window_table(spark, sf_dir, f"stream-late-{kind}", kind, _late_part, LATE_LANDINGS)
    run.__name__ = f"stream_late_{kind}"
    run.__doc__ = (f"Window aggregate '{kind}' of the shared job over five landings, the last with rows days behind "
                   "the watermark: their windows are closed and evicted, so they are dropped.")
    return run


for _kind in W.WINDOW_AGGREGATES:
    register(f"stream_late_{_kind}", _without_late(speed.ORACLES_FOR_STREAMS[f"win_{_kind}"]))(_late_query(_kind))


FLUSH_ROWS = 10


@register("stream_keyed_flush", with_views(ctes("obs"), f"""
SELECT country, city, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_event_id,
       CAST(count(*) // {FLUSH_ROWS} AS BIGINT) AS n_full,
       CAST(ceil(count(*) / {FLUSH_ROWS}.0) AS BIGINT) AS n_flushes,
       CAST((count(*) - 1) % {FLUSH_ROWS} + 1 AS BIGINT) AS last_rows
FROM obs GROUP BY country, city"""))
def stream_keyed_flush(spark, sf_dir):
    """Observations buffered per location and passed on ten at a time over
    four runs on one checkpoint; a row from the future ends the stream, so
    what is left of every location leaves as a last, smaller batch."""
    base = scratch_path(spark, "stream-flush")
    events, loc = read_table(spark, sf_dir, "events"), places(spark, sf_dir)

    def start():
        rows = event_time_to_timestamp(obs_from_events(file_stream(spark, f"{base}/landed", events.schema), loc)).select(
            "country", "city", "event_id", "event_time", "temperature", "windspeed")
        flushed = flush_by_key(rows.withWatermark("event_time", W.DEFAULT_WATERMARK), ["country", "city"], "event_time",
                               FLUSH_ROWS, "60 days", tick="event_id")
        return start_flush(flushed, f"{base}/data", f"{base}/checkpoint")
    closing = {"ts": F.max("ts") + F.expr("INTERVAL 61 DAYS"), "user_id": F.lit(0).cast("long")}
    closing = events.agg(*[closing.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema.fields])
    replay(events, time_parts(events, "ts", LANDINGS), LANDINGS, f"{base}/landed", start, last=closing)
    out = spark.read.parquet(f"{base}/data")
    batches = out.groupBy("country", "city", "flush_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("flush_rows").alias("said"), F.sum("event_id").alias("s"))
    return batches.groupBy("country", "city").agg(
        F.sum("n").alias("n_rows"), F.sum("s").alias("sum_event_id"),
        F.count_if((F.col("n") == FLUSH_ROWS) & (F.col("said") == FLUSH_ROWS)).alias("n_full"),
        F.max("flush_no").alias("n_flushes"), F.max_by("n", "flush_no").alias("last_rows"))


@register("stream_anomalies_versions", history.VERSIONED_SQL)
def stream_anomalies_versions(spark, sf_dir):
    """Anomalies while the profile is replaced between two micro-batches:
    every epoch keeps to the version that it has noted."""
    base, root = scratch_path(spark, "stream-versions"), scratch_path(spark, "profile-versions")
    events, loc = read_table(spark, sf_dir, "events"), places(spark, sf_dir)
    profile = materialize(P.seasonal_profile(daily(spark, sf_dir)))
    versions = iter([profile, profile.withColumn("temp_mean", F.col("temp_mean") + history.PROFILE_SHIFT)])

    def start():
        J.publish_profile(next(versions), root)
        stream = obs_from_events(file_stream(spark, f"{base}/landed", events.schema), loc)
        return (stream.writeStream.foreachBatch(J.versioned_anomaly_writer(root, base))
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    replay(events, time_parts(events, "ts", 2), 2, f"{base}/landed", start)
    return spark.read.parquet(f"{base}/data").drop("_epoch")


@register("stream_parse_metrics", with_views(ctes("obs", extra=[
    "span AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM obs)",
    f"m AS (SELECT (epoch_us(event_time) - lo) * {LANDINGS} // (hi - lo + 1) AS epoch, event_id % 20 AS k FROM obs, span)",
    "e AS (SELECT epoch, count(*) FILTER (k > 3) AS valid, count(*) FILTER (k <= 3) AS rejected, "
    "count(*) FILTER (k = 0) AS unparseable, count(*) FILTER (k = 1) AS missing_time, "
    "count(*) FILTER (k = 2) AS wrong_type, count(*) FILTER (k = 3) AS bad_time FROM m GROUP BY epoch)"]), """
SELECT *, CAST(sum(valid) OVER (ORDER BY epoch) AS BIGINT) AS total_valid,
       CAST(sum(rejected) OVER (ORDER BY epoch) AS BIGINT) AS total_rejected,
       CAST(sum(valid) OVER (ORDER BY epoch) AS DOUBLE) * 100
         / CAST(sum(valid + rejected) OVER (ORDER BY epoch) AS DOUBLE) AS success_pct
FROM e"""))
def stream_parse_metrics(spark, sf_dir):
    """Classification of messages, a fifth of them damaged, over four runs:
    counts of usable and rejected messages per epoch and in total, from the
    metrics table that the job writes."""
    base = scratch_path(spark, "stream-metrics")
    events, loc = read_table(spark, sf_dir, "events"), places(spark, sf_dir)
    kind = F.col("event_id") % 20
    o = obs_from_events(events, loc)
    time = F.when(kind == 3, "yesterday").when(kind != 1, F.col("original_timestamp"))
    fields = ["city", "country", "latitude", "longitude", "temperature", "windspeed", "weather_code"]
    msgs = o.select("event_id", "event_time", F.to_json(F.struct(time.alias("timestamp"), *fields)).alias("value"))
    msgs = msgs.withColumn("value", F.when(kind == 0, F.expr("left(value, length(value) - 7)")).when(
        kind == 2, F.regexp_replace("value", '"temperature":[^,]*', '"temperature":"hot"')).otherwise(F.col("value")))

    def publish(df):
        df.write.format("noop").mode("overwrite").save()

    def start():
        raw = file_stream(spark, f"{base}/landed", msgs.schema)
        parsed = parse_json_column(raw, FLAT_OBSERVATION, raw_col="_raw", bad_col="_bad")
        writer = classification_batch_writer(publish, rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics")
        return (parsed.writeStream.foreachBatch(writer).option("checkpointLocation", f"{base}/checkpoint")
                .trigger(availableNow=True).start())
    replay(msgs, time_parts(msgs, "event_time", LANDINGS), LANDINGS, f"{base}/landed", start)
    m = read_metrics(spark, f"{base}/metrics")
    why = [F.coalesce(F.col("by_reason")[r], F.lit(0).cast("long")).alias(r)
           for r in ("unparseable", "missing_time", "wrong_type", "bad_time")]
    return m.select("epoch", "valid", "rejected", *why, "total_valid", "total_rejected", "success_pct")


@register("stream_classify_defaults", with_views(ctes("obs", extra=[
    "m AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'Unknown' ELSE city END AS city, "
    "CASE WHEN event_id % 7 = 1 THEN 'Unknown' ELSE country END AS country, "
    "CASE WHEN event_id % 7 = 2 THEN 0 ELSE temperature END AS temperature, "
    "CASE WHEN event_id % 7 = 3 THEN 0 ELSE windspeed END AS windspeed FROM obs)"]), f"""
SELECT *, {WIND_LEVEL} AS wind_alert_level, {HEAT_LEVEL} AS heat_alert_level FROM m"""))
def stream_classify_defaults(spark, sf_dir):
    """The loop variant of the classification: messages in which a field is
    really missing get names ``Unknown`` and numbers 0, then their levels."""
    o, kind = obs_stream(spark, sf_dir), F.col("event_id") % 7
    fields = {c: F.when(kind != i, F.col(c)).alias(c) for i, c in enumerate(("city", "country", "temperature", "windspeed"))}
    msgs = o.select("event_id", F.to_json(F.struct(*fields.values())).alias("value"))
    parsed = parse_json_column(msgs, OBSERVATION, keep=("event_id",)).select("event_id", *fields)
    path = S.run_append_to_table(J.classify_stream(parsed, defaults=True), "classify_defaults")
    return spark.read.parquet(path)
