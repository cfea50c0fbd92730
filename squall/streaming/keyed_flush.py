"""Rows buffered per key and passed on in batches of a fixed size.

Every key keeps its waiting rows in a list state; as soon as ``size`` rows are
there they leave as one numbered batch.  A timer on event time passes the rest
on when the key has been quiet for ``idle``.  Rows whose ``tick`` column is
null only move the clock: one far in the future, landed at the end of a finite
stream, lets every timer run out, so no row stays behind.  State lives in RocksDB, a key has at most ``size`` - 1 rows in it,
and rows are taken as they come, an Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from squall.session import ROCKSDB_STATE_CONF

SIZE = 10
IDLE = "1 day"


class KeyedFlush(StatefulProcessor):
    """Batches of ``size`` rows of a key."""

    def __init__(self, schema: StructType, ts_col: str, tick: str | None, size: int, idle_ms: int):
        self.schema, self.ts_col, self.tick, self.size, self.idle_ms = schema, ts_col, tick, size, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.flushed = handle.getValueState("flushed", StructType([StructField("n", LongType())]))

    def _done(self) -> int:
        return self.flushed.get()[0] if self.flushed.exists() else 0

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.waiting.get()), columns=self.schema.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, latest = self._held(), None
        before = done = self._done()
        for pdf in rows:
            pdf = pdf[self.schema.names] if self.tick is None else pdf.loc[pdf[self.tick].notna(), self.schema.names]
            if not len(pdf):
                continue
            last = pdf[self.ts_col].max()
            latest = last if latest is None or last > latest else latest
            held = pd.concat([held, pdf], ignore_index=True) if len(held) else pdf.reset_index(drop=True)
            full = len(held) // self.size
            if full:  # all batches that are full leave in one frame
                out = held.iloc[:full * self.size]
                yield out.assign(flush_no=done + 1 + np.arange(len(out)) // self.size, flush_rows=self.size)
                held, done = held.iloc[full * self.size:], done + full
        if latest is None:
            return
        if done > before:
            self.flushed.update((done,))
        self.waiting.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(held):
            self.waiting.put([tuple(r) for r in held.astype(object).where(held.notna(), None).itertuples(index=False, name=None)])
            self.handle.registerTimer(int(latest.timestamp() * 1000) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        self.waiting.clear()
        if len(held):
            no = self._done() + 1
            self.flushed.update((no,))
            yield held.assign(flush_no=no, flush_rows=len(held))

    def close(self) -> None:
        pass


def flush_by_key(df: DataFrame, keys: list[str], ts_col: str, size: int = SIZE, idle: str = IDLE,
                 tick: str | None = None) -> DataFrame:
    """``df``, a stream with a watermark on ``ts_col``, with ``flush_no``
    (from 1, per key) and ``flush_rows`` of the batch each row leaves in;
    rows with a null ``tick`` are left out."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    out = StructType([*df.schema.fields, StructField("flush_no", LongType()), StructField("flush_rows", IntegerType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        KeyedFlush(df.schema, ts_col, tick, size, idle_ms), outputStructType=out, outputMode="append", timeMode="eventTime")


def start_flush(flushed: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write the batches of ``flush_by_key`` (each row once, by the file
    sink's log) until all that has landed is read."""
    spark = flushed.sparkSession
    before = {k: spark.conf.get(k, None) for k in ROCKSDB_STATE_CONF}
    for k, v in ROCKSDB_STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return (flushed.writeStream.format(fmt).outputMode("append").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
