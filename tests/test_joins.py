import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from squall.operators.anomalies import detect_anomalies_checked
from squall.operators.joins import shared_table

BASE = "country string, city string, month int, base_temp_mean double, " \
       "base_temp_stddev double, base_wind_mean double, base_wind_stddev double"
OBS = "event_time timestamp, country string, city string, temperature double, windspeed double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_table_joins_by_the_size_of_its_files(spark):
    small = shared_table(spark.range(10).withColumn("t", F.expr("repeat('x', 100)")))
    large = shared_table(spark.range(3000).withColumn("t", F.expr("repeat(uuid(), 40)")))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
        under, over = (spark.range(5000).join(t, "id") for t in (small, large))
        assert "BroadcastHashJoin" in _plan(under)
        assert "BroadcastHashJoin" not in _plan(over)
        assert under.count() == 10 and over.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    empty = shared_table(spark.range(0))
    assert spark.range(5).join(empty, "id").count() == 0


def test_location_dimension_is_broadcast_by_its_file_size(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    from squall.sources.testviews import obs
    plan = _plan(obs(spark, sf))
    # the two dimension tables are broadcast, never the observations
    assert plan.count("BuildRight") == 2 and "BuildLeft" not in plan and "SortMergeJoin" not in plan


def test_hot_location_same_result_with_and_without_broadcast(spark):
    t = dt.datetime(2024, 1, 15)
    base = spark.createDataFrame([("X", c, 1, 10.0, 2.0, 5.0, 1.0) for c in "ABCDEF"], BASE)
    rows = [(t, "X", "A", float(i % 20), float(i % 9)) for i in range(600)]      # hot
    rows += [(t, "X", "BCDEF"[i % 5], float(i % 17), float(i % 7)) for i in range(1200)]
    obs = spark.createDataFrame(rows, OBS)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = detect_anomalies_checked(obs, base, only_anomalies=False)
        assert "BroadcastHashJoin" not in _plan(shuffled)
        a = shuffled.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    broadcast = detect_anomalies_checked(obs, base, only_anomalies=False)
    assert "BroadcastHashJoin" in _plan(broadcast)
    b = broadcast.collect()
    assert len(a) == len(b) == 1800
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)
