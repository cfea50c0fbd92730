"""Operators against brute-force pandas computations on random fixtures."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from squall.functions.classify import with_alert_levels
from squall.operators import records as R
from squall.operators import windows as W

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)

obs_rows = st.lists(st.tuples(st.integers(0, 30 * 60 - 1),          # second offset
                              st.sampled_from(["A", "B", "C"]),
                              st.one_of(st.none(), st.floats(-10, 60).map(lambda x: round(x, 2))),
                              st.integers(0, 40).map(float)),
                    min_size=1, max_size=60)


def _brute_windows(rows, size_min=5, slide_min=1):
    """Every 5-minute window (1-minute slide) containing each row."""
    out = {}
    for sec, city, temp, wind in rows:
        minute = sec // 60
        for i in range(size_min // slide_min):
            start = (minute - i * slide_min)
            out.setdefault((start, city), []).append((temp, wind))
    res = {}
    for key, vals in out.items():
        temps = [t for t, _ in vals if t is not None]
        res[key] = (len(vals), (sum(temps) / len(temps)) if temps else None,
                    sum(w for _, w in vals) / len(vals))
    return res


@SETTINGS
@given(obs_rows)
def test_sliding_windows_pane_direct_and_brute_force_agree(spark, rows):
    data = [(T0 + dt.timedelta(seconds=s), c, "X", t, w) for s, c, t, w in rows]
    df = with_alert_levels(spark.createDataFrame(
        data, "event_time timestamp_ntz, city string, country string, "
              "temperature double, windspeed double"))
    expected = _brute_windows(rows)
    for panes in (True, False):
        got = {}
        for r in W.window_city_stats(df, panes=panes).collect():
            start = int((r.window_start - T0).total_seconds() // 60)
            got[(start, r.city)] = (r.message_count, r.avg_temp, r.avg_wind)
        assert got.keys() == expected.keys()
        for k, (n, t, w) in expected.items():
            gn, gt, gw = got[k]
            assert gn == n
            assert (gt is None and t is None) or abs(gt - t) < 1e-9
            assert abs(gw - w) < 1e-9


daily_rows = st.lists(st.tuples(st.integers(0, 120), st.sampled_from(["A", "B"]),
                                st.integers(0, 50).map(float)),
                      min_size=1, max_size=50, unique_by=lambda x: (x[0], x[1]))


@SETTINGS
@given(daily_rows, st.integers(1, 10))
def test_rolling_sum_matches_pandas(spark, rows, n):
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=d), c, "X", p) for d, c, p in rows]
    df = spark.createDataFrame(data, "date date, city string, country string, "
                                     "precipitation double")
    got = {(r.city, r.date): r.s for r in R.rolling_sum(df, "precipitation", n, "s").collect()}
    got_days = {(r.city, r.date): r.s
                for r in R.rolling_sum(df, "precipitation", n, "s", mode="range").collect()}
    pdf = pd.DataFrame(data, columns=["date", "city", "country", "p"]).sort_values("date")
    for city, g in pdf.groupby("city"):
        by_rows = g["p"].rolling(n, min_periods=1).sum()
        ts = g.set_index(pd.to_datetime(g["date"]))["p"]
        by_days = ts.rolling(f"{n}D").sum()
        for (date, a), b in zip(zip(g["date"], by_rows), by_days):
            assert got[(city, date)] == a
            assert got_days[(city, date)] == b


@SETTINGS
@given(daily_rows)
def test_records_match_brute_force(spark, rows):
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=d), c, "X", p, -p, p / 2, p, 0.0, p, p)
            for d, c, p in rows]
    df = spark.createDataFrame(
        data, "date date, city string, country string, temp_max double, temp_min double, "
              "temp_mean double, precipitation double, snowfall double, windspeed_max double, "
              "windgusts_max double")
    got = {r.city: r for r in R.climate_records(df).collect()}
    pdf = pd.DataFrame(data, columns=["date", "city", "country", "temp_max", "temp_min",
                                      "temp_mean", "precipitation", "snowfall",
                                      "windspeed_max", "windgusts_max"])
    for city, g in pdf.groupby("city"):
        g = g.sort_values("date")
        hot = g.sort_values(["temp_max", "date"], ascending=[False, True]).iloc[0]
        cold = g.sort_values(["temp_min", "date"], ascending=[True, True]).iloc[0]
        assert got[city].hottest_date == hot["date"]
        assert got[city].coldest_date == cold["date"]
        assert got[city].total_days == len(g)
