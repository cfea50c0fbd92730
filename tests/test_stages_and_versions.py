"""Document swaps, profile versions, metrics, reject reasons, damaged store
lines and exact rounding."""

import datetime as dt
import os
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from squall.folders import names
from squall.functions.parsing import parse_json_column, reject_reason
from squall.functions.rounding import exact_mean, exact_share
from squall.schemas import FLAT_OBSERVATION, STORED_ALERT
from squall.sinks.files import swap_documents
from squall.sources.files import split_store
from squall.streaming import jobs as J
from squall.streaming import metrics as M
from squall.streaming.apps import classification_batch_writer

DOC = "country string, city string, year string, v int"
COLS = ("country_dir", "city_dir", "year")


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOC)


def stored(spark, path):
    return sorted((r.city, r.year, r.v) for r in spark.read.schema(DOC).json(path).collect())


def test_swap_replaces_only_its_own_documents(spark, tmp_dir):
    path = f"{tmp_dir}/d"
    swap_documents(docs(spark, ("F", "Lyon", "2020", 1), ("F", "Lyon", "2021", 1), ("F", "A b/c", "2020", 1)), path, COLS)
    times = {n: os.path.getmtime(f"{path}/country_dir=F/city_dir={n}") for n in ("A_b_c",)}
    swap_documents(docs(spark, ("F", "Lyon", "2020", 2)), path, COLS)
    assert stored(spark, path) == [("A b/c", "2020", 1), ("Lyon", "2020", 2), ("Lyon", "2021", 1)]
    assert times["A_b_c"] == os.path.getmtime(f"{path}/country_dir=F/city_dir=A_b_c")
    assert not [n for n in names(spark, path) if n.startswith("_")]


@pytest.mark.parametrize("dies_at", [1, 2, 3, 4])
def test_swap_that_dies_leaves_whole_documents_and_is_mended(spark, tmp_dir, monkeypatch, dies_at):
    from squall.sinks import files
    path, moves, move = f"{tmp_dir}/d", [], files.move
    swap_documents(docs(spark, ("F", "L", "2020", 1), ("F", "M", "2020", 1)), path, COLS)

    def dying(*a):
        moves.append(a)
        if len(moves) == dies_at:
            raise RuntimeError("lost")
        move(*a)
    monkeypatch.setattr(files, "move", dying)
    with pytest.raises(RuntimeError, match="lost"):
        swap_documents(docs(spark, ("F", "L", "2020", 2), ("F", "M", "2020", 2)), path, COLS)
    monkeypatch.setattr(files, "move", move)
    left = stored(spark, path)
    assert len(left) == (1 if dies_at % 2 == 0 else 2) and all(v in (1, 2) for *_, v in left)
    swap_documents(docs(spark, ("F", "N", "2020", 3)), path, COLS)
    assert [c for c, *_ in stored(spark, path)] == ["L", "M", "N"]


PROFILE = ("country string, city string, month int, temp_mean double, temp_stddev double, "
           "wind_mean double, wind_stddev double")
OBS = "event_time timestamp, country string, city string, temperature double, windspeed double"


def test_a_retry_keeps_to_its_profile_version(spark, tmp_dir):
    root, base = f"{tmp_dir}/p", f"{tmp_dir}/a"
    batch = spark.createDataFrame([(dt.datetime(2024, 1, 5), "F", "L", 10.0, 5.0)], OBS)

    def profile(mean):
        return spark.createDataFrame([("F", "L", 1, mean, 1.0, 5.0, 1.0)], PROFILE)

    def found():
        return sorted((r["_epoch"], r["profile_version"]) for r in spark.read.parquet(f"{base}/data").collect())
    write = J.versioned_anomaly_writer(root, base)
    with pytest.raises(FileNotFoundError):
        write(batch, 0)
    assert J.publish_profile(profile(50.0), root) == 1
    write(batch, 0)
    assert J.publish_profile(profile(10.0), root) == 2      # nothing is unusual now
    write(batch, 0)                                          # the retry still finds the anomaly
    assert found() == [(0, 1)]
    write(batch, 1)
    assert found() == [(0, 1)]
    os.makedirs(f"{root}/v=3")                               # a version whose writer died
    assert J.publish_profile(profile(-9.0), root) == 4
    write(batch, 2)
    write(batch, 3)
    assert found() == [(0, 1), (2, 4), (3, 4)] and len(names(spark, f"{base}/used")) == 2


MESSAGES = ['{"timestamp": "2026-01-13T15:26:59", "city": "Lyon", "temperature": 3.0}', '{oops', '{"city": "Rome"}',
            '{"timestamp": "2026-01-13T15:26:59", "temperature": "hot"}', '{"timestamp": "yesterday", "city": "Rome"}']


def parsed(spark, messages):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return parse_json_column(df, FLAT_OBSERVATION, raw_col="_raw", bad_col="_bad")


def test_every_reject_has_its_reason(spark):
    rule = reject_reason(FLAT_OBSERVATION.fieldNames(), "timestamp", "_bad", require_time=True)
    got = {r["_raw"]: r["why"] for r in parsed(spark, MESSAGES).select("_raw", rule.alias("why")).collect()}
    assert [got[m] for m in MESSAGES] == [None, "unparseable", "missing_time", "wrong_type", "bad_time"]


def test_metrics_count_each_epoch_once(spark, tmp_dir):
    write = classification_batch_writer(lambda df: df.collect(), rejects_path=f"{tmp_dir}/r", metrics_path=f"{tmp_dir}/m")
    write(parsed(spark, MESSAGES), 0)
    write(parsed(spark, MESSAGES[:1] * 3), 1)
    write(parsed(spark, []), 2)
    write(parsed(spark, MESSAGES), 0)                        # a retry
    got = M.read_metrics(spark, f"{tmp_dir}/m").orderBy("epoch").collect()
    assert [(r.epoch, r.valid, r.rejected, r.total_valid, r.total_rejected, r.success_pct) for r in got] == [
        (0, 1, 4, 1, 4, 20.0), (1, 3, 0, 4, 4, 50.0), (2, 0, 0, 4, 4, 50.0)]
    assert got[0].by_reason == dict.fromkeys(("unparseable", "missing_time", "wrong_type", "bad_time"), 1)
    assert spark.read.parquet(f"{tmp_dir}/r").count() == 4


def test_damaged_store_lines_are_kept_as_rejects(spark, tmp_dir):
    lines = ['{"city": "L", "temperature": 1.5}', "no json", '{"city": "L", "humidity": "wet"}', "", "  ", '{"city": null}']
    spark.createDataFrame([(x, "F", "L") for x in lines], "value string, country_dir string, city_dir string").write.partitionBy(
        "country_dir", "city_dir").text(f"{tmp_dir}/s")
    rows, rejects = split_store(spark, f"{tmp_dir}/s", STORED_ALERT)
    assert sorted(map(str, (r.temperature for r in rows.collect()))) == ["1.5", "None"]
    assert sorted(r["_raw"] for r in rejects.collect()) == sorted(lines[1:3]) and rejects.first()["city_dir"] == "L"


@pytest.mark.parametrize("places", [0, 2, 4, 8])
def test_rounded_means_equal_decimal_ones(spark, places):
    r = random.Random(places)
    groups = {g: [Decimal(r.randrange(-10 ** 6, 10 ** 6)) / 1000 for _ in range(r.randrange(1, 9))] for g in range(200)}
    groups[0], groups[1] = [Decimal("0.005")], [Decimal("-0.005"), Decimal("-0.005")]
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs] + [(900, None)], "g int, x double")
    got = {r["g"]: r for r in df.groupBy("g").agg(exact_mean("x", places).alias("m"), exact_share(F.col("x") > 0, 4).alias("p")).collect()}
    for g, xs in groups.items():
        mean = (sum(xs) / len(xs)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
        share = (Decimal(sum(x > 0 for x in xs)) / len(xs)).quantize(Decimal("0.0001"), ROUND_HALF_UP)
        assert (got[g]["m"], got[g]["p"]) == (float(mean), float(share))
    assert got[900]["m"] is None
