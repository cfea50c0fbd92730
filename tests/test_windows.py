import datetime as dt
import os

from pyspark.sql import functions as F

from squall.functions.classify import with_alert_levels
from squall.operators import windows as W
from squall.streaming import sinks as S

SCHEMA = ("event_time timestamp, city string, country string, temperature double, "
          "windspeed double")


def t(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def test_sliding_window_membership_and_edges(spark):
    df = with_alert_levels(spark.createDataFrame(
        [(t(0, 30), "A", "X", 30.0, 5.0), (t(5), "A", "X", 10.0, 25.0)], SCHEMA))
    out = W.window_global_stats(df).orderBy("window_start").collect()
    starts = [(r.window_start.minute if r.window_start.hour == 0 else r.window_start.minute - 60,
               r.total_messages) for r in out]
    # 00:00:30 is in windows starting -4..0; 00:05:00 (an edge) in 1..5, not in 0
    assert starts == [(-4, 1), (-3, 1), (-2, 1), (-1, 1), (0, 1),
                      (1, 1), (2, 1), (3, 1), (4, 1), (5, 1)]


def test_critical_filters_before_windowing(spark):
    df = with_alert_levels(spark.createDataFrame(
        [(t(1), "A", "X", 30.0, 5.0), (t(1), "A", "X", 10.0, 5.0),
         (t(1), "A", "X", 40.0, 30.0)], SCHEMA))
    rows = W.window_critical_alerts(df, size="1 minute", slide="1 minute").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.wind_level_1, r.wind_level_2, r.heat_level_1, r.heat_level_2) == (0, 1, 1, 1)


def test_stream_update_mode_drops_rows_behind_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    df0 = spark.createDataFrame([(t(0), "A", "X", 20.0, 5.0)], SCHEMA)
    df0.write.mode("append").parquet(src)
    stream = (spark.readStream.schema(df0.schema).option("maxFilesPerTrigger", 1)
              .parquet(src))
    agg = W.window_global_stats(with_alert_levels(stream), size="1 minute",
                                slide="1 minute", watermark="10 minutes")
    base = os.path.join(tmp_dir, "out")
    data = base + "/data"

    def write_batch(batch, epoch):
        (batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(data))

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", base + "/ck").start())
    q.processAllAvailable()
    # advance the watermark to 00:20 - 10 min = 00:10
    spark.createDataFrame([(t(20), "A", "X", 20.0, 5.0)], SCHEMA).write.mode("append").parquet(src)
    q.processAllAvailable()
    # 00:00 is now 20 minutes late: dropped; 00:15 is within the watermark: kept
    spark.createDataFrame([(t(0), "A", "X", 99.0, 5.0), (t(15), "A", "X", 20.0, 5.0)],
                          SCHEMA).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    final = {r.window_start.minute: r.total_messages
             for r in S.latest_updates(spark, data, W.WINDOW_KEYS["global"]).collect()}
    assert final == {0: 1, 20: 1, 15: 1}


def test_fan_out_feeds_every_writer_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(t(0), "A", "X", 20.0, 5.0)], SCHEMA).write.parquet(src)
    seen = []

    def w1(batch, epoch):
        batch.write.mode("append").parquet(os.path.join(tmp_dir, "o1"))

    def w2(batch, epoch):
        seen.append(epoch)
    stream = spark.readStream.schema(
        spark.read.parquet(src).schema).parquet(src)
    q = (stream.writeStream.foreachBatch(S.fan_out(w1, w2))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp_dir, "o1")).count() == 1
    assert seen == [0]


def test_four_named_window_queries_run_concurrently(spark, tmp_dir):
    from squall.streaming.jobs import start_window_queries
    src = os.path.join(tmp_dir, "in")
    rows = [(t(m, s), c, "X", 20.0 + m, 5.0 * m) for m in range(0, 12, 3)
            for s, c in ((0, "A"), (30, "B"))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    stream = with_alert_levels(spark.readStream.schema(
        spark.read.parquet(src).schema).parquet(src))
    out = {}

    def sink(df, name):
        path = os.path.join(tmp_dir, name)
        out[name] = path

        def write(batch, epoch):
            (batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch")
             .parquet(path))
        return (df.writeStream.outputMode("update").foreachBatch(write).queryName(name)
                .option("checkpointLocation", path + "_ck").trigger(availableNow=True).start())

    qs = start_window_queries(stream, sink)
    assert sorted(q.name for q in qs.values()) == sorted(f"window_{k}" for k in W.WINDOW_AGGREGATES)
    for q in qs.values():
        q.awaitTermination()
    batch = with_alert_levels(spark.read.parquet(src))
    for kind, fn in W.WINDOW_AGGREGATES.items():
        got = S.latest_updates(spark, out[f"window_{kind}"], W.WINDOW_KEYS[kind])
        want = fn(batch)
        assert got.count() == want.count()
        assert got.select(*want.columns).exceptAll(want).count() == 0


def test_run_until_any_stops_stops_the_rest(spark, tmp_dir):
    from squall.streaming.apps import run_until_any_stops
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(t(0), "A", "X", 20.0, 5.0)], SCHEMA).write.parquet(src)
    schema = spark.read.parquet(src).schema
    done = (spark.readStream.schema(schema).parquet(src).writeStream.format("noop")
            .option("checkpointLocation", os.path.join(tmp_dir, "c1"))
            .trigger(availableNow=True).start())
    forever = (spark.readStream.schema(schema).parquet(src).writeStream.format("noop")
               .option("checkpointLocation", os.path.join(tmp_dir, "c2"))
               .trigger(processingTime="1 second").start())
    run_until_any_stops(spark, timeout_s=60)
    assert not done.isActive and not forever.isActive


def test_classification_writer_on_a_text_stream(spark, tmp_dir):
    import json
    from squall.functions.parsing import parse_json_column
    from squall.schemas import FLAT_OBSERVATION
    from squall.streaming.apps import classification_batch_writer
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "m.json"), "w") as f:
        f.write(json.dumps({"timestamp": "2026-01-13T15:00:00", "city": "Lyon",
                            "country": "France", "country_code": "FR",
                            "temperature": 36.0, "windspeed": 5.0}) + "\n")
        f.write("{broken\n")
    raw = spark.readStream.format("text").load(src)
    parsed = parse_json_column(raw, FLAT_OBSERVATION, raw_col="_raw")
    published = os.path.join(tmp_dir, "published")
    rejects = os.path.join(tmp_dir, "rejects")
    writer = classification_batch_writer(
        lambda df: df.write.mode("append").parquet(published), rejects_path=rejects)
    q = (parsed.writeStream.foreachBatch(writer)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(published).collect()
    assert len(out) == 1 and out[0].heat_alert_level == "level_2"
    assert out[0].country_code == "FR" and out[0].event_time.startswith("2026-01-13")
    rej = spark.read.parquet(rejects).collect()
    assert [(r._raw, r.reason) for r in rej] == [("{broken", "unparseable")]


def test_single_read_window_aggregates_equal_separate_batch_ones(spark, tmp_dir):
    from squall.streaming.jobs import start_window_queries_single_read
    src = os.path.join(tmp_dir, "in")
    rows = [(t(m, s), c, "X", 15.0 + 3 * m, 4.0 * m) for m in range(0, 14, 2)
            for s, c in ((0, "A"), (20, "B"), (40, "A"))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    stream = with_alert_levels(spark.readStream.schema(
        spark.read.parquet(src).schema).parquet(src))
    paths = {k: os.path.join(tmp_dir, k) for k in W.WINDOW_AGGREGATES}

    def table_writer(path):
        def write(part, epoch):
            (part.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(path))
        return write
    q = start_window_queries_single_read(
        stream, {k: table_writer(p) for k, p in paths.items()},
        os.path.join(tmp_dir, "ck"), available_now=True)
    q.awaitTermination()
    batch = with_alert_levels(spark.read.parquet(src))
    for kind, fn in W.WINDOW_AGGREGATES.items():
        got = S.latest_updates(spark, paths[kind], W.WINDOW_KEYS[kind])
        want = fn(batch)
        assert got.count() == want.count(), kind
        assert got.select(*want.columns).exceptAll(want).count() == 0, kind


def test_retried_epoch_replaces_its_earlier_attempt(spark, tmp_dir):
    """A micro-batch re-run after a failure overwrites its own _epoch
    partition, so the final table has no duplicates."""
    path = os.path.join(tmp_dir, "t")
    keys = ["k"]

    def write(df, epoch):
        (df.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(path))
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    write(first, 0)
    write(spark.createDataFrame([("a", 2)], "k string, v int"), 1)
    write(spark.createDataFrame([("a", 2)], "k string, v int"), 1)   # retry of epoch 1
    got = {r.k: r.v for r in S.latest_updates(spark, path, keys).collect()}
    assert got == {"a": 2, "b": 1}
    assert spark.read.parquet(path).count() == 3


def test_console_sink_update_mode(spark, tmp_dir, capsys):
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(t(0), "A", "X", 20.0, 5.0)], SCHEMA).write.parquet(src)
    stream = with_alert_levels(spark.readStream.schema(
        spark.read.parquet(src).schema).parquet(src))
    agg = W.window_global_stats(stream, size="1 minute", slide="1 minute")
    q = S.to_console(agg, mode="update", query_name="console_probe",
                     checkpoint=os.path.join(tmp_dir, "ck"))
    q.processAllAvailable()
    assert q.name == "console_probe"
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1
    q.stop()
    assert not q.isActive
