import datetime as dt

from pyspark.sql import functions as F

from squall.functions.labels import month_name_fr, weather_label
from squall.functions.names import location_key, safe_name, split_location_key
from squall.functions.parsing import (parse_json_column, reject_flag, tolerant_timestamp,
                                      with_defaults)
from squall.schemas import OBSERVATION


def test_tolerant_timestamp_formats(spark):
    rows = [("2026-01-13T15:26:59.123456",), ("2026-01-13T15:26:59Z",),
            ("2026-01-13 15:26:59",), ("",), ("not a time",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(tolerant_timestamp("s").cast("timestamp_ntz")).collect()]
    assert got[0] == dt.datetime(2026, 1, 13, 15, 26, 59, 123456)
    assert got[1] == dt.datetime(2026, 1, 13, 15, 26, 59)
    assert got[2] == dt.datetime(2026, 1, 13, 15, 26, 59)
    assert got[3:] == [None, None, None]


def test_tolerant_timestamp_fallback_now(spark):
    df = spark.createDataFrame([("garbage",)], "s string")
    (v,) = df.select(tolerant_timestamp("s", fallback_now=True)).first()
    assert v is not None


def test_parse_json_coercion_and_rejects(spark):
    msgs = ['{"city": "Lyon", "temperature": 21, "weather_code": 3, "humidity": 40}',
            '{"city": "Rome", "weather_code": 3.0}',
            'not json at all',
            '{"unrelated": 1}']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    parsed = parse_json_column(df, OBSERVATION, raw_col="_raw")
    rows = parsed.withColumn("rej", reject_flag(OBSERVATION.fieldNames())).collect()
    assert rows[0]["temperature"] == 21.0 and rows[0]["humidity"] == 40.0
    assert rows[1]["city"] == "Rome" and rows[1]["weather_code"] is None
    assert [r["rej"] for r in rows] == [False, False, True, True]
    assert rows[2]["_raw"] == "not json at all"


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None)],
                               "city string, temperature double, wind_alert_level string")
    r = with_defaults(df).first()
    assert (r.city, r.temperature, r.wind_alert_level) == ("Unknown", 0.0, "unknown")


def test_safe_names(spark):
    df = spark.createDataFrame([("Pays-Bas", "L'Aquila / Centre", "New York")],
                               "country string, city string, c3 string")
    r = df.select(safe_name("country").alias("a"), safe_name("city").alias("b"),
                  safe_name("city", "basic").alias("c"), safe_name("country", "strict").alias("d"),
                  safe_name("c3").alias("e"), location_key().alias("k")).first()
    assert r.a == "Pays-Bas"
    assert r.b == "LAquila___Centre"
    assert r.c == "L'Aquila___Centre"
    assert r.d == "Pays_Bas"
    assert r.e == "New_York"
    assert r.k == "Pays-Bas/L'Aquila / Centre"


def test_split_location_key(spark):
    df = spark.createDataFrame([("France/Lyon",)], "location string")
    c, t = split_location_key("location")
    assert tuple(df.select(c, t).first()) == ("France", "Lyon")


def test_labels(spark):
    df = spark.createDataFrame([(0, 1), (53, 8), (95, 12), (None, None)], "c int, m int")
    got = [tuple(r) for r in df.select(weather_label("c"), month_name_fr("m")).collect()]
    assert got[0] == ("Ciel dégagé", "Janvier")
    assert got[1] == ("Code 53", "Août")
    assert got[2] == ("Orage", "Décembre")
    assert got[3] == (None, None)


def test_to_json_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string")
    text = df.select(F.to_json(F.struct("*")).alias("value"))
    back = parse_json_column(text, df.schema).first()
    assert tuple(back) == (1, 2.5, "x")


def test_count_rejects_observation(spark):
    from squall.functions.parsing import count_rejects
    df = spark.createDataFrame([('{"city": "A"}',), ("bad",)], "value string")
    parsed = parse_json_column(df, OBSERVATION)
    out, obs = count_rejects(parsed, OBSERVATION.fieldNames())
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"valid": 1, "rejected": 1}


def test_normalise_wind_units(spark):
    from squall.functions.units import normalise_wind
    df = spark.createDataFrame([(36.0, {"wind_speed_10m": "km/h"}), (5.0, {"wind_speed_10m": "m/s"}),
                                (7.0, None)], "windspeed double, units map<string,string>")
    got = [round(r.windspeed, 9) for r in normalise_wind(df).collect()]
    assert got == [10.0, 5.0, 7.0]


def test_split_rejects_routes_bad_messages(spark):
    from squall.functions.parsing import split_rejects
    from squall.schemas import FLAT_OBSERVATION
    msgs = ['{"timestamp": "2026-01-13T15:26:59", "city": "Lyon", "temperature": 3.0}',
            '{"timestamp": "yesterday", "city": "Rome"}',
            '{oops']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    parsed = parse_json_column(df, FLAT_OBSERVATION, raw_col="_raw")
    valid, rejected = split_rejects(parsed, FLAT_OBSERVATION.fieldNames(), time_col="timestamp")
    assert [r.city for r in valid.collect()] == ["Lyon"]
    assert "_raw" not in valid.columns
    got = sorted((r.reason, r._raw) for r in rejected.collect())
    assert got == [("bad_time", msgs[1]), ("unparseable", "{oops")]


def test_parse_kafka_records_with_envelope(spark):
    import datetime as dt
    import json as _json
    from squall.schemas import FLAT_OBSERVATION, KAFKA_ENVELOPE
    from squall.streaming.sources import parse_kafka_json
    msg = _json.dumps({"timestamp": "2026-01-13T15:00:00", "city": "Lyon", "temperature": 3.5,
                       "units": {"temperature_2m": "°C"}}).encode()
    rec = (None, bytearray(msg), "weather_stream", 0, 42, dt.datetime(2026, 1, 13, 15, 0, 1), 0)
    raw = spark.createDataFrame([rec], KAFKA_ENVELOPE)
    r = parse_kafka_json(raw, FLAT_OBSERVATION, keep_envelope=True).first()
    assert (r.city, r.temperature, r.units["temperature_2m"]) == ("Lyon", 3.5, "°C")
    assert (r.topic, r.partition, r.offset) == ("weather_stream", 0, 42)
    assert r.timestamp == "2026-01-13T15:00:00" and r.kafka_timestamp is not None


def test_count_rejects_on_a_stream(spark, tmp_dir):
    import os
    from squall.functions.parsing import count_rejects
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"city": "Lyon"}\n{bad\n{"city": "Rome"}\n')
    parsed = parse_json_column(spark.readStream.format("text").load(src), OBSERVATION)
    out, name = count_rejects(parsed, OBSERVATION.fieldNames())
    q = (out.writeStream.format("noop").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    metrics = [p.observedMetrics.get(name) for p in q.recentProgress
               if p.observedMetrics and name in p.observedMetrics]
    row = metrics[0]
    assert (row["valid"], row["rejected"]) == (2, 1)


def test_display_key_round_trip(spark):
    from squall.functions.names import display_key, split_display_key
    df = spark.createDataFrame([("Lyon", "France")], "city string, country string")
    label = df.select(display_key().alias("label"))
    assert label.first().label == "Lyon, France"
    city, country = split_display_key("label")
    assert tuple(label.select(city, country).first()) == ("Lyon", "France")


def test_tolerant_timestamp_with_offset(spark):
    df = spark.createDataFrame([("2026-01-13T17:26:59+02:00",)], "s string")
    (v,) = df.select(tolerant_timestamp("s").cast("timestamp_ntz")).first()
    assert v == dt.datetime(2026, 1, 13, 15, 26, 59)      # UTC session time
