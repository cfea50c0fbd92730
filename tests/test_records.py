import datetime as dt

from squall.operators.records import climate_records, records_document, rolling_sum

COLS = ("date date, city string, country string, temp_max double, temp_min double, "
        "temp_mean double, precipitation double, snowfall double, windspeed_max double, "
        "windgusts_max double")


def _daily(spark, rows):
    return spark.createDataFrame(rows, COLS)


def d(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def test_records_ties_take_earliest_date_and_skip_nulls(spark):
    rows = [(d(0), "A", "X", 30.0, None, 20.0, 1.0, 0.0, 5.0, 10.0),
            (d(1), "A", "X", 30.0, 2.0, 20.0, 1.0, 3.0, 5.0, 10.0),
            (d(2), "A", "X", 10.0, 2.0, 5.0, 1.0, 3.0, None, None),
            (d(3), "B", "Y", None, None, None, None, None, None, None)]
    rec = {r.city: r for r in climate_records(_daily(spark, rows)).collect()}
    a = rec["A"]
    assert a.hottest_date == d(0)
    assert a.coldest_date == d(1)          # the null temp_min row never wins
    assert a.windiest_date == d(0)
    assert a.snowiest_date == d(1)
    assert a.rain_30days == 3.0 and a.rainiest_date == d(2)
    assert a.total_days == 3 and a.total_precipitation == 3.0
    b = rec["B"]
    assert b.hottest_date is None and b.total_days == 1


def test_rolling_rows_vs_range_with_gaps(spark):
    # 3-row / 3-day window with a gap after day 1
    rows = [(d(0), "A", "X", 1.0, 1.0, 1.0, 1.0, 0.0, 1.0, 1.0),
            (d(1), "A", "X", 1.0, 1.0, 1.0, 2.0, 0.0, 1.0, 1.0),
            (d(5), "A", "X", 1.0, 1.0, 1.0, 4.0, 0.0, 1.0, 1.0),
            (d(6), "A", "X", 1.0, 1.0, 1.0, 8.0, 0.0, 1.0, 1.0)]
    df = _daily(spark, rows)
    by_rows = [r.s for r in rolling_sum(df, "precipitation", 3, "s").orderBy("date").collect()]
    by_days = [r.s for r in rolling_sum(df, "precipitation", 3, "s", mode="range")
               .orderBy("date").collect()]
    assert by_rows == [1.0, 3.0, 7.0, 14.0]     # partial at the start, gaps ignored
    assert by_days == [1.0, 3.0, 4.0, 12.0]     # calendar days


def test_descriptions_have_plain_digits_or_are_null(spark):
    rows = [(d(0), "A", "X", 12345678.25, -0.0005, 1.0, 1.0, None, 5.0, 100.0)]
    doc = records_document(climate_records(_daily(spark, rows))).collect()[0]
    assert doc.hottest_day.description == "Jour le plus chaud: 12345678.25°C"
    assert doc.coldest_day.description == "Jour le plus froid: -0.0005°C"
    assert doc.windiest_day.description == "Rafale la plus forte: 100.0 m/s"
    assert doc.snowiest_day is None or doc.snowiest_day.description is None


def test_rolling_window_is_partitioned_by_location(spark):
    rows = [(d(i), c, "X", 1.0, 1.0, 1.0, 1.0, 0.0, 1.0, 1.0) for i in range(3) for c in "AB"]
    df = rolling_sum(_daily(spark, rows), "precipitation", 30, "s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert sorted(r.s for r in df.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]
