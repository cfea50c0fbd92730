"""Batches per key: sizes, each row once, quiet keys, ticks and restarts."""

import datetime as dt
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from squall.streaming.keyed_flush import KeyedFlush, flush_by_key, start_flush
from squall.streaming.landing import replay
from squall.streaming.sources import file_stream

SCHEMA = "city string, id long, at timestamp, note string"
T0 = dt.datetime(2024, 1, 1)


def run(spark, tmp_dir, landings, size=4, idle="2 hours"):
    rows = spark.createDataFrame([(*r, n) for n, rs in enumerate(landings) for r in rs], SCHEMA + ", n int")

    def start():
        stream = file_stream(spark, f"{tmp_dir}/in", rows.drop("n").schema).withWatermark("at", "10 minutes")
        return start_flush(flush_by_key(stream, ["city"], "at", size, idle, tick="id"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    folder = f"{tmp_dir}/in"
    for n in range(len(landings)):
        replay(rows.filter(F.col("n") == n).drop("n"), F.lit(0), 1, folder, start)
    out = defaultdict(list)
    for r in spark.read.parquet(f"{tmp_dir}/out").collect():
        out[r["city"], r["flush_no"]].append(r)
    return out


def test_full_batches_rest_and_every_row_once(spark, tmp_dir):
    rows = [("a" if i % 3 else "b", i, T0 + dt.timedelta(minutes=i), None if i % 2 else "x") for i in range(50)]
    end = [("a", None, T0 + dt.timedelta(days=2), None)]
    out = run(spark, tmp_dir, [rows[:5], rows[5:30], rows[30:], end])
    sizes = {k: len(v) for k, v in out.items()}
    assert {k: n for k, n in sizes.items() if k[0] == "a"} == {("a", i): 4 for i in range(1, 9)} | {("a", 9): 1}
    assert {k: n for k, n in sizes.items() if k[0] == "b"} == {("b", i): 4 for i in range(1, 5)} | {("b", 5): 1}
    assert all(r["flush_rows"] == len(v) for v in out.values() for r in v)
    assert Counter((r["id"], r["note"]) for v in out.values() for r in v) == Counter((r[1], r[3]) for r in rows)


def test_quiet_key_is_passed_on_while_another_goes_on(spark, tmp_dir):
    a = [("a", i, T0 + dt.timedelta(minutes=i), "n") for i in range(3)]
    b = [("b", 100 + i, T0 + dt.timedelta(hours=3, minutes=i), "n") for i in range(2)]
    again = [("a", 200, T0 + dt.timedelta(hours=4), "n")]
    out = run(spark, tmp_dir, [a, b, again])
    assert sorted(r["id"] for r in out["a", 1]) == [0, 1, 2]
    assert ("a", 2) not in out and ("b", 1) not in out  # still waiting: no closing row has landed


class State:
    """One key's state and timers, counting the writes."""

    def __init__(self):
        self.value, self.writes, self.timers = None, 0, []

    def getListState(self, *_):
        return State()

    def getValueState(self, *_):
        self.flushed = State()
        return self.flushed

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value or ()

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    put = update

    def clear(self):
        self.value = None

    def listTimers(self):
        return list(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_frames_and_state_writes_do_not_grow_with_the_batches():
    schema = StructType([StructField("id", LongType()), StructField("at", TimestampType())])
    key, state = KeyedFlush(schema, "at", "id", 10, 1000), State()
    key.init(state)
    pieces = [pd.DataFrame({"id": range(n, n + 1003), "at": pd.Timestamp(T0)}) for n in range(0, 4012, 1003)]
    out = [list(key.handleInputRows(("k",), iter(pieces[:3]), None)), list(key.handleInputRows(("k",), iter(pieces[3:]), None)),
           list(key.handleExpiredTimer(("k",), None, None))]
    assert [len(frames) for frames in out] == [3, 1, 1] and state.flushed.writes == 3
    rows = pd.concat([f for frames in out for f in frames])
    assert rows["id"].tolist() == list(range(4012))
    assert rows["flush_no"].tolist() == [i // 10 + 1 for i in range(4012)]
    assert rows["flush_rows"].tolist() == [10] * 4010 + [2] * 2
