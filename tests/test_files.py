import json
import os

from pyspark.sql import functions as F

from squall.schemas import STORED_ALERT
from squall.sinks.files import write_location_store
from squall.sources.files import (catalogue, read_json_documents, read_json_lines,
                                  read_location_store, read_positional)

ALERT = {"event_time": "2026-01-13T15:26:59.1", "city": "Lyon", "country": "France",
         "country_code": None, "temperature": 4.2, "windspeed": 12.0,
         "wind_alert_level": "level_1", "heat_alert_level": "level_0", "weather_code": 3,
         "humidity": 80, "precipitation": 0.0}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_json_lines_skip_blank_and_malformed(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.json")
    _write(p, json.dumps(ALERT) + "\n\n{broken\n" + json.dumps({**ALERT, "city": "Rome"}) + "\n")
    rows = read_json_lines(spark, p, STORED_ALERT).collect()
    assert [r.city for r in rows] == ["Lyon", "Rome"]
    assert rows[0].humidity == 80.0


def test_multiline_documents(spark, tmp_dir):
    doc = {"city": "Lyon", "country": "France", "profiles": [{"month": 1}, {"month": 2}]}
    _write(os.path.join(tmp_dir, "d1", "profile.json"), json.dumps(doc, indent=2))
    schema = "city string, country string, profiles array<struct<month int>>"
    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)
    df = read_json_documents(spark, os.path.join(tmp_dir, "d1"), st)
    r = df.first()
    assert r.city == "Lyon" and [p.month for p in r.profiles] == [1, 2]
    # without multiLine the indented document does not parse
    flat = read_json_lines(spark, os.path.join(tmp_dir, "d1"), st, drop_malformed=False)
    assert flat.filter(F.col("city").isNotNull()).count() == 0


def test_positional_layout_and_catalogue(spark, tmp_dir):
    for country, city in [("France", "Lyon"), ("Pays-Bas", "Amsterdam"), ("Royaume-Uni", "New York")]:
        _write(os.path.join(tmp_dir, country, city, "alerts.json"),
               json.dumps({**ALERT, "city": city, "country": country}) + "\n")
    df = read_positional(spark, tmp_dir, "alerts.json", STORED_ALERT)
    cat = [tuple(r) for r in catalogue(df).collect()]
    assert cat == [("France", "Lyon"), ("Pays-Bas", "Amsterdam"), ("Royaume-Uni", "New York")]


def test_location_store_round_trip(spark, tmp_dir):
    rows = [{**ALERT, "humidity": 80.0, "city": c, "country": k} for c, k in
            [("L'Aquila", "Italie"), ("New York", "Etats Unis"), ("Lyon", "France")]]
    df = spark.createDataFrame([tuple(r[f] for f in STORED_ALERT.fieldNames()) for r in rows],
                               STORED_ALERT)
    path = os.path.join(tmp_dir, "store")
    write_location_store(df, path)
    write_location_store(df, path)          # append
    back = read_location_store(spark, path)
    counts = {(r.country_dir, r.city_dir): r["count"] for r in
              back.groupBy("country_dir", "city_dir").count().collect()}
    assert counts == {("Italie", "LAquila"): 2, ("Etats_Unis", "New_York"): 2,
                      ("France", "Lyon"): 2}
    assert sorted(r.city for r in back.collect())[:2] == ["L'Aquila", "L'Aquila"]


def test_write_documents_dynamic_overwrite(spark, tmp_dir):
    from squall.sinks.files import write_documents
    path = os.path.join(tmp_dir, "docs")
    a = spark.createDataFrame([("France", "Lyon", 1), ("France", "Paris", 1)],
                              "country string, city string, v int")
    write_documents(a, path)
    b = spark.createDataFrame([("France", "Lyon", 2)], "country string, city string, v int")
    write_documents(b, path)      # replaces Lyon only
    got = {(r.city, r.v) for r in spark.read.json(path).collect()}
    assert got == {("Lyon", 2), ("Paris", 1)}


def test_load_history_types_dates(spark, tmp_dir):
    from squall.sources.files import load_history
    p = os.path.join(tmp_dir, "h.json")
    _write(p, json.dumps({"date": "2014-01-01", "city": "Lyon", "temp_max": 3}) + "\n"
           + json.dumps({"date": "not-a-date", "city": "Lyon"}) + "\n")
    rows = load_history(spark, p).collect()
    assert str(rows[0].date) == "2014-01-01" and rows[0].temp_max == 3.0
    assert len(rows) == 1
    from squall.sources.files import split_history
    with open(p, "a") as f:
        f.write("\nno json\n" + json.dumps({"date": "2014-01-02", "city": "Lyon", "temp_max": "hot"}) + "\n"
                + json.dumps({"date": "2014-01-01", "city": "Lyon", "temp_max": 9}) + "\n")
    _, rejects = split_history(spark, p)
    assert sorted(r["reason"] for r in rejects.collect()) == ["bad_date", "duplicate_day", "malformed", "malformed"]
