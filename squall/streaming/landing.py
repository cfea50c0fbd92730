"""Rows that land piece by piece: every landing is one run of the stream on
the same checkpoint, so offsets, watermark and state are taken up each time
exactly as after a stop and restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def time_parts(df: DataFrame, ts_col: str, n: int) -> Column:
    """Which of ``n`` equal stretches of the table's time a row is in (from
    0); rows without a time are in the first."""
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    if lo is None:
        return F.lit(0).cast("long")
    return F.coalesce(F.expr(f"(unix_micros(cast(`{ts_col}` as timestamp)) - {lo}) * {n} div {hi - lo + 1}"), F.lit(0).cast("long"))


def replay(df: DataFrame, part: Column, n: int, folder: str, start: Callable[[], StreamingQuery],
           last: DataFrame | None = None) -> None:
    """Append the rows of part 0, 1 .. n - 1 to ``folder`` and run
    ``start()``, a query that ends when it has read all there is, after each.
    ``last`` lands after them in a run of its own."""
    pieces = [df.filter(part == i) for i in range(n)] + ([last] if last is not None else [])
    for piece in pieces:
        piece.write.mode("append").parquet(folder)
        start().awaitTermination()
