import datetime as dt

from squall.operators.anomalies import anomaly_feed, detect_anomalies, detect_anomalies_checked

BASE = "country string, city string, month int, base_temp_mean double, " \
       "base_temp_stddev double, base_wind_mean double, base_wind_stddev double"
OBS = "event_time timestamp, country string, city string, temperature double, windspeed double"


def _obs(spark, rows):
    t = dt.datetime(2024, 1, 15, 12, 0)
    return spark.createDataFrame([(t,) + r for r in rows], OBS)


def test_anomaly_rules(spark):
    base = spark.createDataFrame([("X", "A", 1, 10.0, 2.0, 5.0, 1.0),
                                  ("X", "N", 1, 10.0, None, 5.0, None)], BASE)
    obs = _obs(spark, [
        ("X", "A", 14.0, 5.0),    # exactly 2 sigma: not an anomaly
        ("X", "A", 14.5, 5.0),    # heat wave
        ("X", "A", 5.0, 5.0),     # cold wave
        ("X", "A", 10.0, 8.0),    # wind storm
        ("X", "A", 20.0, 20.0),   # both: temperature wins
        ("X", "N", 99.0, 99.0),   # null sigma: never anomalous
        ("X", "Z", 99.0, 99.0),   # unknown city
        ("X", "A", None, None),   # null measures
    ])
    rows = detect_anomalies(obs, base, only_anomalies=False).collect()
    got = [(r.is_anomaly, r.anomaly_type, r.variable) for r in rows]
    assert got == [(False, None, None), (True, "heat_wave", "temperature"),
                   (True, "cold_wave", "temperature"), (True, "wind_storm", "windspeed"),
                   (True, "heat_wave", "temperature"), (False, None, None),
                   (False, None, None), (False, None, None)]
    heat = rows[1]
    assert (heat.observed_value, heat.expected_value, heat.deviation, heat.threshold) == \
        (14.5, 10.0, 4.5, 4.0)
    only = detect_anomalies(obs, base).count()
    assert only == 4


def test_checked_variant_broadcasts_small_baseline(spark):
    base = spark.createDataFrame([("X", "A", 1, 10.0, 2.0, 5.0, 1.0)], BASE)
    obs = _obs(spark, [("X", "A", 14.5, 5.0)])
    df = detect_anomalies_checked(obs, base)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert df.count() == 1


def test_anomaly_feed_percent_and_labels(spark):
    base = spark.createDataFrame([("X", "A", 1, 0.0, 1.0, 5.0, 1.0),
                                  ("X", "B", 1, 10.0, 1.0, 5.0, 1.0)], BASE)
    obs = _obs(spark, [("X", "A", 5.0, 5.0), ("X", "B", 10.0, 10.0)])
    rows = {r.city: r for r in anomaly_feed(detect_anomalies(obs, base)).collect()}
    assert rows["A"].pct_deviation is None           # expected 0: no division error
    assert rows["A"].anomaly_label == "HEAT WAVE" and rows["A"].unit == "°C"
    assert rows["B"].anomaly_label == "WIND STORM" and rows["B"].unit == "m/s"
    assert rows["B"].pct_deviation == 100.0
    assert rows["B"].event_time_text == "2024-01-15 12:00:00"


def test_baseline_from_indented_profile_documents(spark, tmp_dir):
    import json
    import os
    from pyspark.sql.types import StructType
    from squall.sources.files import read_json_documents
    doc = {"city": "Lyon", "country": "France", "generated_at": "2026-01-13T00:00:00",
           "profiles": [{"month": 1, "month_name": "Janvier",
                         "temperature": {"mean": 4.0, "stddev": 2.0},
                         "wind": {"mean": 10.0, "stddev": 3.0}, "days_count": 341}]}
    os.makedirs(os.path.join(tmp_dir, "France", "Lyon"))
    with open(os.path.join(tmp_dir, "France", "Lyon", "profile.json"), "w") as f:
        json.dump(doc, f, indent=2)
    schema = StructType.fromDDL(
        "city string, country string, generated_at string, profiles array<struct<"
        "month int, month_name string, temperature struct<mean double, stddev double>, "
        "wind struct<mean double, stddev double>, days_count bigint>>")
    docs = read_json_documents(spark, os.path.join(tmp_dir, "*", "*", "profile.json"), schema)
    from squall.operators.anomalies import baseline_from_documents
    base = baseline_from_documents(docs)
    obs = _obs(spark, [("France", "Lyon", 9.0, 10.0), ("France", "Lyon", 5.0, 17.0)])
    got = [(r.anomaly_type, r.threshold) for r in detect_anomalies(obs, base).collect()]
    assert got == [("heat_wave", 4.0), ("wind_storm", 6.0)]


def test_baseline_rounding_option(spark):
    from squall.operators.anomalies import baseline
    prof = spark.createDataFrame([("X", "A", 1, 10.126, 2.004, 5.555, 1.0)],
                                 "country string, city string, month int, temp_mean double, "
                                 "temp_stddev double, wind_mean double, wind_stddev double")
    full = baseline(prof).first()
    rounded = baseline(prof, digits=2).first()
    assert full.base_temp_mean == 10.126
    assert (rounded.base_temp_mean, rounded.base_temp_stddev) == (10.13, 2.0)
