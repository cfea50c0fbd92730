"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.session import scratch_path, shared_dir

# a word is a maximal run of characters other than the six ASCII blanks;
# ``bytes.split()`` cuts at the same six bytes
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives the loss
    of executors; Spark removes the files once the DataFrame is gone)."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Keep the Arrow batches handed to Python small enough for long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def byte_slices(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of rows whose last column (binary) holds at most
    ``limit`` bytes together; a longer value is a stretch of its own."""
    first = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()):
        if i > first and held + (n or 0) > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n or 0
    if batch.num_rows > first:
        yield batch.slice(first)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_safe(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job made, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in the block delete their shuffle files as they end (Spark 4.1;
    others keep them until the driver collects its garbage)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_table(df: DataFrame, name: str, *, free_shuffles: bool = False) -> DataFrame:
    """``df`` written to and read from the shared folder; the files go when
    the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark) if free_shuffles else nullcontext():
        df.write.parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def sql_crc32(text: str) -> str:
    """DuckDB expression of the unsigned CRC-32 of an ASCII text."""
    bits = "list_reduce(list_concat([xor(a, b)], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    over = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {over}), lambda a, b: {bits}), 4294967295)"
