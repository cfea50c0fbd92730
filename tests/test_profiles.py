import datetime as dt

from squall.operators import profiles as P

COLS = ("date date, city string, country string, temp_max double, temp_min double, "
        "temp_mean double, precipitation double, rain double, snowfall double, "
        "windspeed_max double, windgusts_max double")


def _row(month, day, tmean, wind, city="A"):
    return (dt.date(2020, month, day), city, "X", tmean + 5, tmean - 5, tmean, 1.0, 1.0, 0.0,
            wind, None if wind is None else wind * 2)


def test_seasonal_profile_single_row_month_has_null_stddev(spark):
    rows = [_row(1, 1, 10.0, 5.0), _row(1, 2, 30.0, 15.0), _row(2, 1, 40.0, 25.0)]
    prof = {r.month: r for r in P.seasonal_profile(spark.createDataFrame(rows, COLS)).collect()}
    assert prof[1].temp_mean == 20.0 and prof[1].days_count == 2
    assert abs(prof[1].temp_stddev - 14.142135623730951) < 1e-12
    assert prof[1].heat_alert_probability == 0.5 and prof[1].wind_alert_probability == 0.5
    assert prof[2].temp_stddev is None
    assert prof[2].heat_alert_probability == 1.0


def test_validation_missing_months_nulls_and_unrealistic(spark):
    rows = [_row(1, 1, 10.0, 5.0), _row(1, 2, 10.0, None), _row(3, 1, 10.0, 70.0)]
    v = P.validate_profile(spark.createDataFrame(rows, COLS)).first()
    assert v.months_present == 2 and v.is_valid is False
    assert v.errors == ["Profil incomplet: seulement 2/12 mois présents"]
    assert v.warnings == ["Mois 1: 1 valeurs de vent manquantes",
                          "1 valeurs non réalistes détectées"]


def test_validation_complete_profile(spark):
    rows = [_row(m, 1, 10.0, 5.0) for m in range(1, 13)]
    v = P.validate_profile(spark.createDataFrame(rows, COLS)).first()
    assert v.is_valid is True and v.errors == [] and v.warnings == []


def test_enriched_quantiles_and_iqr(spark):
    rows = [_row(1, d, float(d), float(d)) for d in range(1, 9)]
    e = P.enriched_profile(spark.createDataFrame(rows, COLS)).first()
    assert (e.temp_q25, e.temp_median, e.temp_q75) == (2.0, 4.0, 6.0)
    assert e.temp_iqr == 4.0 and e.wind_iqr == 4.0


def test_annual_summary_ties_take_earliest_month(spark):
    rows = [_row(m, 1, 20.0 if m in (3, 7) else 10.0, 5.0) for m in range(1, 13)]
    s = P.annual_summary(P.seasonal_profile(spark.createDataFrame(rows, COLS))).first()
    assert s.hottest_month == "Mars"
    assert s.coldest_month == "Janvier"
    assert s.windiest_month == "Janvier"


def test_profile_document_round_trip(spark, tmp_dir):
    rows = [_row(m, d, 10.0 + m, 5.0) for m in range(1, 13) for d in (1, 2)]
    daily = spark.createDataFrame(rows, COLS)
    docs = P.profile_document(P.enriched_profile(daily), P.validate_profile(daily), year=2020)
    docs.write.json(tmp_dir + "/docs")
    back = spark.read.schema(docs.schema).json(tmp_dir + "/docs")
    months = [r.month for r in P.explode_profiles(back).collect()]
    assert months == list(range(1, 13))
    assert back.first().validation.is_valid is True and back.first().year == "2020"


def test_batch_layer_writes_three_document_sets(spark, tmp_dir):
    import json
    import os
    from squall.batch_layer import run_batch_layer
    path = os.path.join(tmp_dir, "history.json")
    with open(path, "w") as f:
        for m in range(1, 13):
            for d in (1, 2):
                f.write(json.dumps({"date": f"2020-{m:02d}-{d:02d}", "city": "Lyon",
                                    "country": "France", "temp_max": 20.0 + d,
                                    "temp_min": 5.0, "temp_mean": 12.0 + d,
                                    "precipitation": 1.0, "rain": 1.0, "snowfall": 0.0,
                                    "windspeed_max": 8.0 + d, "windgusts_max": 16.0,
                                    "weather_code": 3}) + "\n")
    out = run_batch_layer(spark, path, os.path.join(tmp_dir, "out"))
    rec = spark.read.json(out["records"]).first()
    assert rec.statistics.total_days == 24 and rec.country == "France"
    prof = spark.read.json(out["profiles"]).first()
    assert [p.month for p in prof.profiles] == list(range(1, 13))
    enr = spark.read.json(out["enriched"]).first()
    assert enr.validation.is_valid is True and len(enr.profiles) == 12
    # re-running for one year adds a year level without touching the rest
    out2 = run_batch_layer(spark, path, os.path.join(tmp_dir, "out"), year=2020)
    years = sorted(r.year for r in spark.read.json(out2["enriched"]).select("year").collect())
    assert years == ["2020", "all"]
