from pyspark.sql import functions as F

from squall.functions.classify import (critical_flag, heat_level, heat_level_num,
                                       wind_level, wind_level_num)


def test_wind_threshold_edges(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (20.0,), (20.01,), (None,)], "w double")
    got = [r[0] for r in df.select(wind_level("w")).collect()]
    assert got == ["level_0", "level_1", "level_1", "level_2", "unknown"]


def test_heat_threshold_edges(spark):
    df = spark.createDataFrame([(24.99,), (25.0,), (35.0,), (35.01,), (None,)], "t double")
    got = [r[0] for r in df.select(heat_level("t")).collect()]
    assert got == ["level_0", "level_1", "level_1", "level_2", "unknown"]


def test_numeric_levels_missing_is_zero(spark):
    df = spark.createDataFrame([(30.0, 25.0), (None, None), (40.0, 5.0)], "t double, w double")
    got = [tuple(r) for r in df.select(heat_level_num("t"), wind_level_num("w")).collect()]
    assert got == [(1, 2), (0, 0), (2, 0)]


def test_critical_flag(spark):
    df = spark.createDataFrame(
        [("level_2", "level_0"), ("level_1", "level_2"), ("level_1", "level_1"), (None, None)],
        "w string, h string")
    got = [r[0] for r in df.select(critical_flag("w", "h")).collect()]
    assert got == [True, True, False, False]


def test_classification_stays_in_codegen(spark):
    df = spark.range(10).select((F.col("id") * 3.0).alias("w")).select(wind_level("w"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_stream_classify_defaults_reproduce_loop_behaviour(spark):
    from squall.streaming.jobs import classify_stream
    df = spark.createDataFrame([(None, None, None)],
                               "city string, temperature double, windspeed double")
    plain = classify_stream(df).first()
    filled = classify_stream(df, defaults=True).first()
    assert (plain.wind_alert_level, plain.heat_alert_level) == ("unknown", "unknown")
    assert (filled.wind_alert_level, filled.heat_alert_level) == ("level_0", "level_0")
    assert filled.city == "Unknown"


def test_kafka_app_transform_on_batch(spark):
    from squall.streaming.apps import classified_from_observations
    df = spark.createDataFrame([("2026-01-13T15:26:59.5", "Lyon", 36.0, 21.0)],
                               "timestamp string, city string, temperature double, windspeed double")
    r = classified_from_observations(df).first()
    assert r.heat_alert_level == "level_2" and r.wind_alert_level == "level_2"
    assert r.event_time is not None and r.processed_at is not None
    assert r.original_timestamp == "2026-01-13T15:26:59.5"


def test_classified_messages_keep_code_region_units(spark):
    import json
    from squall.functions.parsing import parse_json_column
    from squall.schemas import CLASSIFIED_OBSERVATION
    msg = {"event_time": "2026-01-13T15:26:59", "city": "Lyon", "country": "France",
           "country_code": "FR", "region": "Auvergne-Rhône-Alpes", "temperature": 3.5,
           "units": {"wind_speed_10m": "km/h"}, "wind_alert_level": "level_0"}
    df = spark.createDataFrame([(json.dumps(msg),)], "value string")
    r = parse_json_column(df, CLASSIFIED_OBSERVATION).first()
    assert (r.country_code, r.region, r.units["wind_speed_10m"]) == \
        ("FR", "Auvergne-Rhône-Alpes", "km/h")
