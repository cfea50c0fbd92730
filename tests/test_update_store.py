"""The table of newest rows: compaction, readers, retries, recovery."""

import datetime as dt
import os

import pytest

from squall.operators import windows as W
from squall.streaming import jobs as J
from squall.streaming import update_store as U
from squall.streaming.landing import replay, time_parts
from squall.streaming.sources import file_stream

SCHEMA = "k long, v long"


def batch(spark, epoch):
    return spark.createDataFrame([(k, epoch) for k in (epoch % 3, 10 + epoch)], SCHEMA)


def table(spark, base, schema):
    return {r.k: r.v for r in U.read_updates(spark, base, ["k"], schema).collect()}


def test_folders_stay_few_and_rows_the_same(spark, tmp_dir):
    schema, want = batch(spark, 0).schema, {}
    write = U.update_writer(f"{tmp_dir}/t", ["k"], schema, every=3)
    for epoch in range(20):
        before = U.read_updates(spark, f"{tmp_dir}/t", ["k"], schema)
        old = dict(want)
        write(batch(spark, epoch), epoch)
        want |= {epoch % 3: epoch, 10 + epoch: epoch}
        assert table(spark, f"{tmp_dir}/t", schema) == want
        # a reader planned before the batch (and its compaction) still reads what it planned
        assert {r.k: r.v for r in before.collect()} == old
    n = {d: len([x for x in os.listdir(f"{tmp_dir}/t/{d}") if not x.startswith(".")]) for d in os.listdir(f"{tmp_dir}/t")}
    assert n["snapshots"] <= 2 and n["pointers"] <= 2 and n["epochs"] <= 9


def test_retries_and_lost_attempts(spark, tmp_dir):
    base, schema = f"{tmp_dir}/t", batch(spark, 0).schema
    assert table(spark, base, schema) == {}
    write = U.update_writer(base, ["k"], schema, every=100)
    for epoch in range(4):
        write(batch(spark, epoch), epoch)
    write(spark.createDataFrame([(99, 3)], SCHEMA), 3)            # the retry has other rows
    os.makedirs(f"{base}/epochs/_epoch=4")                        # an attempt that never ended
    spark.createDataFrame([(5, 5)], SCHEMA).write.parquet(f"{base}/snapshots/1")  # a compaction without a pointer
    want = {0: 0, 10: 0, 1: 1, 11: 1, 2: 2, 12: 2, 99: 3}
    assert table(spark, base, schema) == want
    U.compact(spark, base, ["k"], schema, 3)
    assert table(spark, base, schema) == want and U.pointers(spark, base) == [(1, 3)]
    U.compact(spark, base, ["k"], schema, 3)                      # nothing new to merge
    assert U.pointers(spark, base) == [(1, 3)]


def _obs(n):
    at = dt.datetime(2024, 1, 1)
    return [(at + dt.timedelta(minutes=7 * i), "F", "LMN"[i % 3], float(i % 40), float(i % 25)) for i in range(n)]


OBS = "event_time timestamp, country string, city string, temperature double, windspeed double"


@pytest.mark.parametrize("fail_after_write", [False, True])
def test_batch_lost_before_its_commit_is_taken_up_again(spark, tmp_dir, fail_after_write):
    """A run dies in the second batch, before or after the batch is written
    and in any case before its commit; the next run repeats that batch."""
    rows = spark.createDataFrame(_obs(400), OBS)
    part, lost, seen = time_parts(rows, "event_time", 4), [], []

    def start(broken=None):
        def write(out, epoch_id):
            seen.append(epoch_id)
            put = U.update_writer(f"{tmp_dir}/city", W.WINDOW_KEYS["city"], out.schema, every=2)
            if epoch_id == broken:
                if fail_after_write:
                    put(out, epoch_id)
                lost.append(epoch_id)
                raise RuntimeError("lost")
            put(out, epoch_id)
            start.schema = out.schema
        return J.start_window_queries_single_read(J.classify_stream(file_stream(spark, f"{tmp_dir}/landed", rows.schema)),
                                                  {"city": write}, f"{tmp_dir}/checkpoint", available_now=True)
    replay(rows, part, 2, f"{tmp_dir}/landed", start)
    rows.filter(part == 2).write.mode("append").parquet(f"{tmp_dir}/landed")
    broken = max(seen) + 1
    with pytest.raises(Exception, match="lost"):
        start(broken).awaitTermination()
    rows.filter(part == 3).write.mode("append").parquet(f"{tmp_dir}/landed")
    start().awaitTermination()
    assert lost == [broken] and seen.count(broken) == 2
    keys = W.WINDOW_KEYS["city"]
    got = U.read_updates(spark, f"{tmp_dir}/city", keys, start.schema).orderBy(*keys).collect()
    want = W.window_city_stats(J.classify_stream(rows)).orderBy(*keys).collect()
    assert [tuple(r[c] for c in want[0].asDict()) for r in got] == [tuple(r) for r in want]


def test_parts_of_an_empty_table_and_of_missing_times(spark):
    empty = spark.createDataFrame([], OBS)
    assert empty.select(time_parts(empty, "event_time", 3)).collect() == []
    rows = spark.createDataFrame([*_obs(9), (None, "F", "L", 1.0, 1.0)], OBS)
    parts = [r[0] for r in rows.select(time_parts(rows, "event_time", 3)).collect()]
    assert sorted(parts) == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2] and parts[-1] == 0
