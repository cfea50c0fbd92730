"""Micro-batches without anomalies, retries, counters and missing values."""

import datetime as dt
from types import SimpleNamespace

from squall.operators import records as R
from squall.streaming import jobs as J
from squall.streaming.apps import MessageCounter

PROFILE = ("country string, city string, month int, temp_mean double, temp_stddev double, "
           "wind_mean double, wind_stddev double")
OBS = "event_time timestamp, country string, city string, temperature double, windspeed double"


def _obs(spark, *temps):
    return spark.createDataFrame([(dt.datetime(2024, 1, 5), "F", "L", t, 5.0) for t in temps], OBS)


def test_quiet_batches_and_retries(spark, tmp_dir, monkeypatch):
    sent = []
    monkeypatch.setattr(J.S, "batch_to_kafka", lambda df, *_: sent.append(df.count()))
    spark.createDataFrame([("F", "L", 1, 10.0, 1.0, 5.0, 1.0)], PROFILE).write.parquet(f"{tmp_dir}/p")
    write = J.anomaly_batch_writer(f"{tmp_dir}/p", f"{tmp_dir}/out", kafka_servers="none")
    write(_obs(spark, 10.0), 0)                  # no anomaly at all
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 0
    write(_obs(spark, 10.0, 50.0, -50.0), 1)
    write(_obs(spark, 10.0), 2)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2
    write(_obs(spark, 10.0), 1)                  # a retry replaces its epoch
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 0
    assert sent == [0, 2, 0, 0]


def test_counter_outlives_the_progress_list():
    c = MessageCounter()
    c.onQueryStarted(SimpleNamespace(name="q", id="i"))
    for _ in range(250):
        c.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(name="q", id="i", numInputRows=3)))
    assert c.counts == {"q": 750}


def test_no_description_without_a_value(spark):
    day = spark.createDataFrame([(dt.date(2020, 1, 1), "L", "F", 1.0, 0.0, None, 2.0, None, 3.0, 4.0)],
                                "date date, city string, country string, temp_max double, temp_min double, rain double, "
                                "precipitation double, snowfall double, windspeed_max double, windgusts_max double")
    doc = R.records_document(R.climate_records(day)).collect()[0]
    assert doc["snowiest_day"]["description"] is None
    assert doc["hottest_day"]["description"].endswith("1.0°C")


def test_store_batches_make_one_file_a_location_and_replace_themselves(spark, tmp_dir):
    rows = [(dt.datetime(2024, 1, 5), "F", c, float(i), 5.0) for i in range(40) for c in "LMN"]
    batch = spark.createDataFrame(rows, OBS).repartition(8)
    write = J.store_batch_writer(f"{tmp_dir}/store")
    write(batch, 0)
    write(batch, 1)
    write(batch.filter("city = 'L'"), 1)         # a retry with fewer places
    files = [f for f in spark.read.text(f"{tmp_dir}/store").inputFiles()]
    assert len(files) == 4
    stored = spark.read.json(f"{tmp_dir}/store")
    assert stored.count() == 160 and stored.filter("city_dir = 'M'").count() == 40
