"""The rows that an update-mode stream emits, kept as a table of the newest
row per key.

``epochs/_epoch=N`` holds what micro-batch N emitted; a retry replaces the
folder whole.  Once enough epochs are closed (a later one has begun, so they
are committed) they are merged with the last snapshot into ``snapshots/V``,
and an empty file in ``pointers``, created in one step, says that the table
now is snapshot V and the epochs after the one in its name.  Readers follow
the newest pointer.  What a pointer replaces is deleted when the pointer after
it stands, so a reader that began before is not harmed and the folder count is
bounded: two snapshots and the epochs of two rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from squall.folders import delete, mark, names

EVERY = 8


def pointers(spark: SparkSession, base: str) -> list[tuple[int, int]]:
    """(snapshot, last epoch in it), oldest first."""
    return [tuple(map(int, n.split("_"))) for n in names(spark, f"{base}/pointers")]


def epochs(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n.removeprefix("_epoch=")) for n in names(spark, f"{base}/epochs") if n.startswith("_epoch="))


def _rows(spark: SparkSession, base: str, keys: list[str], schema: StructType, upto: int | None = None) -> DataFrame:
    """Newest row per key with its ``_epoch``."""
    version, done = (pointers(spark, base) or [(0, -1)])[-1]
    full = StructType([*schema.fields, StructField("_epoch", LongType())])
    parts = [spark.read.schema(full).parquet(f"{base}/snapshots/{version}")] if version else []
    # _SUCCESS tells a whole folder from one that a lost attempt left behind
    new = [f"{base}/epochs/_epoch={n}" for n in epochs(spark, base) if n > done and (upto is None or n <= upto)]
    new = [p for p in new if "_SUCCESS" in names(spark, p)]
    if new:
        parts.append(spark.read.schema(full).option("basePath", f"{base}/epochs").parquet(*new))
    df = parts[0] if parts else spark.createDataFrame([], full)
    df = df.unionByName(parts[1]) if len(parts) > 1 else df
    values = [c for c in schema.names if c not in keys] + ["_epoch"]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_epoch")).alias("v")).select(*keys, "v.*")


def read_updates(spark: SparkSession, base: str, keys: list[str], schema: StructType) -> DataFrame:
    """The table: newest row per key; empty if no batch ran."""
    return _rows(spark, base, keys, schema).select(*schema.names)


def compact(spark: SparkSession, base: str, keys: list[str], schema: StructType, upto: int) -> None:
    """Merge the snapshot and the epochs up to ``upto``, point to the result,
    and delete what the pointer before has replaced."""
    known = pointers(spark, base)
    version, done = (known or [(0, -1)])[-1]
    if upto <= done:
        return
    # a folder of this number without a pointer is left from a lost attempt
    _rows(spark, base, keys, schema, upto).write.mode("overwrite").parquet(f"{base}/snapshots/{version + 1}")
    if not mark(spark, pointer := f"{base}/pointers/{version + 1:09d}_{upto:012d}"):
        raise RuntimeError(f"{pointer} stands already: two writers on one table")
    for n in epochs(spark, base):
        if n <= done:
            delete(spark, f"{base}/epochs/_epoch={n}")
    for old, last in known[:-1]:
        delete(spark, f"{base}/snapshots/{old}")
        delete(spark, f"{base}/pointers/{old:09d}_{last:012d}")


def update_writer(base: str, keys: list[str], schema: StructType, every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the table: writes the epoch, and merges
    the closed ones when there are ``every`` of them."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch.select(*schema.names).write.mode("overwrite").parquet(f"{base}/epochs/_epoch={epoch_id}")
        done = (pointers(spark, base) or [(0, -1)])[-1][1]
        if epoch_id - 1 - done >= every:
            compact(spark, base, keys, schema, epoch_id - 1)
    return write_batch
