"""Cross-operator invariants on the driver's smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from squall.operators import profiles as P
from squall.operators import records as R
from squall.sources.testviews import daily

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def hist(spark):
    return daily(spark, SF).cache()


def test_basic_and_enriched_means_agree(hist):
    keys = ["country", "city", "month"]
    b = P.seasonal_profile(hist).select(*keys, F.col("temp_mean").alias("b"),
                                        F.col("days_count").alias("bd"))
    e = P.enriched_profile(hist).select(*keys, F.col("temp_mean").alias("e"),
                                        F.col("days_count").alias("ed"))
    j = b.join(e, keys, "full")
    assert j.filter(F.col("b").isNull() | F.col("e").isNull()).count() == 0
    assert j.filter(F.abs(F.col("b") - F.col("e")) > 1e-9).count() == 0
    assert j.filter(F.col("bd") != F.col("ed")).count() == 0


def test_iqr_is_q75_minus_q25(hist):
    e = P.enriched_profile(hist)
    bad = e.filter((F.col("temp_iqr") != F.col("temp_q75") - F.col("temp_q25"))
                   | (F.col("temp_q25") > F.col("temp_median"))
                   | (F.col("temp_median") > F.col("temp_q75")))
    assert bad.count() == 0


def test_days_count_sums_to_record_total(hist):
    per_loc = P.seasonal_profile(hist).groupBy("country", "city").agg(
        F.sum("days_count").alias("days"))
    rec = R.climate_records(hist).select("country", "city", "total_days")
    j = per_loc.join(rec, ["country", "city"])
    assert j.count() == rec.count()
    assert j.filter(F.col("days") != F.col("total_days")).count() == 0


def test_records_are_extremes(hist):
    rec = R.climate_records(hist)
    bad = rec.filter((F.col("hottest_temp_max") != F.col("absolute_max_temp"))
                     | (F.col("coldest_temp_min") != F.col("absolute_min_temp"))
                     | (F.col("windiest_gust") != F.col("absolute_max_wind")))
    assert bad.count() == 0


def test_archive_round_trip_is_identity(hist):
    from squall.sources.payloads import explode_archive, pack_archive
    back = explode_archive(pack_archive(hist)).select(*hist.columns)
    assert back.exceptAll(hist).count() == 0 and hist.exceptAll(back).count() == 0
