import json

from squall.functions.parsing import parse_json_column
from squall.schemas import ARCHIVE_PAYLOAD, GEOCODING_PAYLOAD, NESTED_OBSERVATION
from squall.sources import payloads as PL


def _parse(spark, objs, schema):
    df = spark.createDataFrame([(json.dumps(o),) for o in objs], "value string")
    return parse_json_column(df, schema)


def test_archive_explode_concatenates_years(spark):
    def payload(year, n):
        days = [f"{year}-01-{d:02d}" for d in range(1, n + 1)]
        return {"city": "Lyon", "country": "France", "latitude": 45.7, "longitude": 4.8,
                "daily": {"time": days, "temperature_2m_max": [10.0] * n,
                          "temperature_2m_min": [0.0] * n, "temperature_2m_mean": [5.0] * n,
                          "precipitation_sum": [1.0] * n, "rain_sum": [1.0] * n,
                          "snowfall_sum": [0.0] * n, "windspeed_10m_max": [3.0] * n,
                          "windgusts_10m_max": [6.0] * n, "weathercode": [3] * n}}
    rows = PL.explode_archive(_parse(spark, [payload(2014, 3), payload(2015, 2)],
                                     ARCHIVE_PAYLOAD)).collect()
    assert len(rows) == 5
    assert str(rows[0].date) == "2014-01-01" and rows[0].weather_code == 3


def test_pack_then_explode_is_identity(spark):
    import datetime as dt
    daily = spark.createDataFrame(
        [(dt.date(2020, 1, d), "A", "X", 1.0, 2.0, 9.0, float(d), 5.0, 1.0, 0.5, 0.0, 3.0, 6.0, 2)
         for d in (3, 1, 2)],
        "date date, city string, country string, latitude double, longitude double, "
        "temp_max double, temp_min double, temp_mean double, precipitation double, "
        "rain double, snowfall double, windspeed_max double, windgusts_max double, "
        "weather_code int")
    back = PL.explode_archive(PL.pack_archive(daily))
    assert sorted(r.temp_min for r in back.collect()) == [1.0, 2.0, 3.0]


def test_current_payload_flatten_drops_missing_current(spark):
    full = {"timestamp": "2026-01-13T15:00:00", "latitude": 1.0, "longitude": 2.0,
            "city": "Lyon",
            "weather_data": {"current": {"temperature_2m": 4.2, "relative_humidity_2m": 80,
                                         "precipitation": 0.0, "weather_code": 3,
                                         "wind_speed_10m": 12.0, "wind_direction_10m": 200},
                             "current_units": {"temperature_2m": "°C"}}}
    three = {**full, "weather_data": {"current": {"temperature_2m": 1.0,
                                                  "wind_speed_10m": 2.0,
                                                  "weather_code": 1}}}
    missing = {**full, "weather_data": {"current_units": {}}}
    rows = PL.flatten_current(_parse(spark, [full, three, missing], NESTED_OBSERVATION)).collect()
    assert len(rows) == 2
    assert rows[0].humidity == 80.0 and rows[0].units["temperature_2m"] == "°C"
    assert rows[1].temperature == 1.0 and rows[1].humidity is None


def test_geocoding_prefers_requested_country_else_first(spark):
    cands = [{"name": "Paris", "country": "France", "country_code": "FR", "latitude": 48.8,
              "longitude": 2.3, "admin1": "IDF", "population": 2000000},
             {"name": "Paris", "country": "United States", "country_code": "US",
              "latitude": 33.6, "longitude": -95.5, "admin1": "Texas", "population": 25000}]
    payloads = [{"query_name": "Paris", "query_country": "us", "results": cands},
                {"query_name": "Paris", "query_country": "DE", "results": cands},
                {"query_name": "Paris", "query_country": None, "results": cands}]
    res = PL.resolve_locations(PL.candidates_from_payloads(
        _parse(spark, payloads, GEOCODING_PAYLOAD)))
    got = {r.query_country: (r.country_code, r.code_matched) for r in res.collect()}
    assert got == {"us": ("US", True), "DE": ("FR", False), None: ("FR", False)}


def test_archive_explicit_period(spark):
    import datetime as dt
    daily = spark.createDataFrame(
        [(dt.date(2014 + y, 1, 1), "A", "X", 1.0, 2.0, 9.0, 1.0, 5.0, 1.0, 0.5, 0.0, 3.0, 6.0, 2)
         for y in range(11)],
        "date date, city string, country string, latitude double, longitude double, "
        "temp_max double, temp_min double, temp_mean double, precipitation double, "
        "rain double, snowfall double, windspeed_max double, windgusts_max double, "
        "weather_code int")
    out = PL.explode_archive(PL.pack_archive(daily), start="2015-01-01", end="2024-12-31")
    assert out.count() == 10


def test_gazetteer_resolution_matches_per_request_rule(spark):
    cands = spark.createDataFrame(
        [("Paris", 0, "France", "FR", 48.8, 2.3, "IDF", 2000000),
         ("Paris", 1, "United States", "US", 33.6, -95.5, "Texas", 25000),
         ("Paris", 2, "United States", "US", 38.2, -84.2, "Kentucky", 9000),
         ("Lyon", 0, "France", "FR", 45.7, 4.8, "ARA", 500000)],
        "name string, pos int, country string, country_code string, latitude double, "
        "longitude double, admin1 string, population bigint")
    req = spark.createDataFrame([("Paris", "us"), ("Paris", "DE"), ("Lyon", "FR"),
                                 ("Nowhere", "FR")], "query_name string, query_country string")
    got = {(r.query_name, r.query_country): (r.admin1, r.code_matched)
           for r in PL.resolve_against_gazetteer(req, cands).collect()}
    assert got == {("Paris", "us"): ("Texas", True), ("Paris", "DE"): ("IDF", False),
                   ("Lyon", "FR"): ("ARA", True), ("Nowhere", "FR"): (None, False)}


def test_conflicting_days_keep_the_least_row_and_are_counted(spark):
    cols = ("date string, city string, country string, latitude double, longitude double, "
            "temp_max double, temp_min double, temp_mean double, precipitation double, "
            "rain double, snowfall double, windspeed_max double, windgusts_max double, "
            "weather_code int")

    def day(date, temp_max, code):
        return (date, "A", "X", 1.0, 2.0, temp_max, 0.0, 5.0, 1.0, 0.5, 0.0, 3.0, 6.0, code)
    rows = [day("2020-01-01", 9.0, 2), day("2020-01-01", 8.0, 3), day("2020-01-01", 9.0, 2),
            day("2020-01-02", None, 1), day("2020-01-02", 7.0, 1), day("2020-01-03", 4.0, 5), day("2020-01-03", 4.0, 5)]
    for order in (rows, rows[::-1]):
        daily = spark.createDataFrame(order, cols).withColumnRenamed("date", "d").selectExpr(
            "cast(d as date) as date", "* except (d)").repartition(4)
        got = sorted((str(r.date), r.temp_max, r.weather_code) for r in PL.explode_archive(PL.pack_archive(daily)).collect())
        assert got == [("2020-01-01", 8.0, 3), ("2020-01-02", None, 1), ("2020-01-03", 4.0, 5)]
        assert sorted((str(r.date), r.n_rows, r.n_versions) for r in PL.archive_conflicts(daily).collect()) == [
            ("2020-01-01", 3, 2), ("2020-01-02", 2, 2)]
