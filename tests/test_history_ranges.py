"""Rolling sums over ranges of a long history, rejects beside the batch
layer's documents, and the catalogue from the listing."""

import datetime as dt
import json
import os
import random

import pytest

from squall.batch_layer import run_batch_layer
from squall.operators.records import rolling_sum
from squall.sinks.files import write_location_store
from squall.sources.files import rejects_by_reason, store_catalogue, stored_files

SCHEMA = "country string, city string, date date, precipitation double, rain_30days string"


def history(seed):
    r = random.Random(seed)
    start = dt.date(1950, 1, 1)
    days = {"Hot": range(0, 2500), "Sparse": sorted(r.sample(range(9000), 60)), "One": [4], None: range(0, 700, 3)}
    return [("F", c, start + dt.timedelta(days=d), r.choice([None, float(r.randrange(9))]), "own")
            for c, ds in days.items() for d in ds]


def plain(rows, n, mode):
    out = {}
    for c in {r[1] for r in rows}:
        own = sorted((r[2], r[3]) for r in rows if r[1] == c)
        for i, (day, _) in enumerate(own):
            near = own[max(0, i - n + 1):i + 1] if mode == "rows" else [x for x in own if 0 <= (day - x[0]).days < n]
            have = [v for _, v in near if v is not None]
            out[c, day] = sum(have) if have else None
    return out


@pytest.mark.parametrize("mode", ["rows", "range"])
def test_ranges_with_their_halo_equal_the_plain_sum(spark, mode):
    rows = history(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rolling_sum(df, n=30, mode=mode, span_days=100, range_rows=64, out_col="rain_30days").collect()
    assert len(got) == len(rows)
    assert {(r["city"], r["date"]): r["rain_30days"] for r in got} == plain(rows, 30, mode)


def test_a_hot_location_is_spread_over_tasks(spark):
    df = spark.createDataFrame(history(1), SCHEMA).filter("city = 'Hot'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        summed = rolling_sum(df, n=30, span_days=100, range_rows=64)
        sizes = [n for n in summed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 2500 and len(sizes) == 4 and max(sizes) < 1250


def test_empty_history(spark):
    for mode in "rows", "range":
        assert rolling_sum(spark.createDataFrame([], SCHEMA), mode=mode).count() == 0


def test_batch_layer_writes_what_it_rejects(spark, tmp_dir):
    day = {"city": "Lyon", "country": "France", "temp_max": 3.0, "temp_min": 1.0, "temp_mean": 2.0, "precipitation": 1.0,
           "windspeed_max": 4.0, "windgusts_max": 5.0}
    lines = [json.dumps({"date": f"2020-01-{d:02d}", **day}) for d in range(1, 11)]
    lines += ["", "no json", lines[0], json.dumps({"date": "soon", **day}), json.dumps({**day, "date": "2020-02-01", "temp_max": "hot"})]
    with open(os.path.join(tmp_dir, "h.json"), "w") as f:
        f.write("\n".join(lines))
    for _ in range(2):  # a rerun replaces the rejects
        out = run_batch_layer(spark, f"{tmp_dir}/h.json", f"{tmp_dir}/out")
        assert {r["reason"]: r["n"] for r in rejects_by_reason(spark, out["rejects"]).collect()} == {
            "malformed": 2, "duplicate_day": 1, "bad_date": 1}
    assert spark.read.json(out["records"]).select("statistics.total_days").first()[0] == 10


def test_catalogue_opens_no_file(spark, tmp_dir):
    rows = [("Côte d'Ivoire", "A/B +1", 1.0), ("France", "Lyon", 2.0), (None, "X=y%z", 3.0)] * 20
    write_location_store(spark.createDataFrame(rows, "country string, city string, temperature double"), f"{tmp_dir}/s")
    got = [tuple(r) for r in store_catalogue(spark, f"{tmp_dir}/s").collect()]
    stored = spark.read.json(f"{tmp_dir}/s").select("country_dir", "city_dir").distinct().collect()
    assert got == sorted(map(tuple, stored)) and len(got) == 3
    for r in stored_files(spark, f"{tmp_dir}/s").collect():
        os.remove(r["file"].removeprefix("file:"))
        with open(r["file"].removeprefix("file:"), "w") as f:
            f.write("not what a reader expects")
    assert [tuple(r) for r in store_catalogue(spark, f"{tmp_dir}/s").collect()] == got
