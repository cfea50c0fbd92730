import datetime as dt

from squall.operators import reports as RP
from squall.session import scale_conf

T = dt.datetime(2024, 1, 1, 12, 0)
ALERTS = ("event_id bigint, event_time timestamp_ntz, city string, country string, "
          "temperature double, windspeed double, weather_code int, "
          "wind_alert_level string, heat_alert_level string")


def _alerts(spark, rows):
    return spark.createDataFrame(rows, ALERTS)


def test_latest_and_first_rows_break_time_ties_by_id(spark):
    rows = [(i, T, "A", "X", 1.0, 1.0, 0, "level_0", "level_0") for i in range(4)]
    rows += [(9, T - dt.timedelta(hours=1), "A", "X", 1.0, 1.0, 0, "level_0", "level_0")]
    df = _alerts(spark, rows)
    assert [r.event_id for r in RP.latest(df, 2).collect()] == [3, 2]
    first = RP.first_rows_per_location(df, 2).orderBy("rank").collect()
    assert [r.event_id for r in first] == [9, 0]


def test_reports_drop_null_keys_and_count_null_levels_as_raised(spark):
    rows = [(1, T, "A", "X", 30.0, 25.0, 3, "level_2", None),
            (2, T, None, "X", 10.0, 5.0, 3, "level_0", "level_0"),
            (3, T, "A", "X", 20.0, 5.0, 61, "level_0", "level_0")]
    df = _alerts(spark, rows)
    st = RP.city_stats(df).collect()
    assert len(st) == 1 and st[0].wind_alerts == 1 and st[0].heat_alerts == 1
    top = RP.top_weather_by_country(df).first()
    assert (top.weather_description, top["count"]) == ("Couvert", 2)
    k = RP.kpis(df).first()
    assert (k.total_alerts, k.cities, k.countries) == (3, 1, 1)


def test_month_year_table_discovers_years(spark):
    daily = spark.createDataFrame(
        [(dt.date(2020, 1, 5), "A", "X", 1.0), (dt.date(2021, 1, 5), "A", "X", 3.0)],
        "date date, city string, country string, temp_mean double")
    row = RP.month_year_table(daily).first()
    assert (row["2020"], row["2021"]) == (1.0, 3.0)


def test_parquet_location_store(spark, tmp_dir):
    import os
    from squall.sinks.files import write_location_store
    df = _alerts(spark, [(1, T, "New York", "Etats Unis", 1.0, 1.0, 0, "level_0", "level_0")])
    path = os.path.join(tmp_dir, "pq")
    write_location_store(df, path, fmt="parquet")
    back = spark.read.parquet(path).first()
    assert (back.city_dir, back.country_dir, back.city) == ("New_York", "Etats_Unis", "New York")


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 819200
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "200"
