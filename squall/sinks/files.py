"""File sinks: the per-location alert store and document outputs.

Rows are written with Spark's partitioned writer (one folder per
``country_dir=…/city_dir=…``), on any Hadoop file system URI.  Before the
write the rows are *rebalanced* on the location columns: adaptive execution
then splits a location holding a large share of the rows over several
tasks and packs small ones together, so file sizes stay even without a
per-location single-writer bottleneck.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.folders import delete, folder, move, names
from squall.functions.names import safe_name

DIR_COLS = ("country_dir", "city_dir")


def with_location_dirs(df: DataFrame, rule: str = "default",
                       country: str = "country", city: str = "city") -> DataFrame:
    return df.withColumns({"country_dir": F.coalesce(safe_name(country, rule), F.lit("Unknown")),
                           "city_dir": F.coalesce(safe_name(city, rule), F.lit("Unknown"))})


def write_location_store(df: DataFrame, path: str, fmt: str = "json", mode: str = "append",
                         rule: str = "default", max_records_per_file: int = 5_000_000,
                         partition_overwrite: str = "dynamic") -> None:
    """Append rows under ``path/country_dir=…/city_dir=…`` (JSON Lines by
    default, Parquet with ``fmt="parquet"``).  ``mode="overwrite"`` replaces
    the locations written, or all of ``path`` with
    ``partition_overwrite="static"``."""
    out = with_location_dirs(df, rule).hint("rebalance", *DIR_COLS)
    (out.write.mode(mode).partitionBy(*DIR_COLS)
        .option("partitionOverwriteMode", partition_overwrite)
        .option("maxRecordsPerFile", max_records_per_file)
        .format(fmt).save(path))


def write_documents(df: DataFrame, path: str, partition_cols=DIR_COLS,
                    fmt: str = "json", rule: str = "default") -> None:
    """Overwrite one document set per partition (dynamic partition overwrite:
    re-running for one location replaces only that location's folder).

    By default the folders are the path-safe location names, so ``country``
    and ``city`` stay inside each document as well."""
    if set(DIR_COLS) & set(partition_cols):
        df = with_location_dirs(df, rule)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).format(fmt).save(path))


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``path``, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{d}/{n}" for d in found for n in names(spark, path + d) if "=" in n]
    return found


def swap_documents(df: DataFrame, path: str, partition_cols=DIR_COLS, fmt: str = "json", rule: str = "default") -> None:
    """Replace the documents of the locations in ``df`` (and of no other).

    The new documents are written whole into a staging folder that readers do
    not look into; then folder by folder the old one is moved aside and the
    new one into its place, so a reader finds a whole old or a whole new
    document, or none between the two moves, never part of one.  A run that
    died between them is mended first: what was moved aside and not replaced
    goes back.  One writer at a time."""
    spark, depth = df.sparkSession, len(partition_cols)
    for old in (n for n in names(spark, path) if n.startswith("_old-")):
        for leaf in _leaves(spark, f"{path}/{old}", depth):
            fs, p = folder(spark, path + leaf)
            if not fs.exists(p):
                move(spark, f"{path}/{old}{leaf}", path + leaf)
    for left in (n for n in names(spark, path) if n.startswith(("_old-", "_new-"))):
        delete(spark, f"{path}/{left}")
    run = uuid.uuid4().hex[:12]
    if set(DIR_COLS) & set(partition_cols):
        df = with_location_dirs(df, rule)
    df.write.partitionBy(*partition_cols).format(fmt).save(f"{path}/_new-{run}")
    for leaf in _leaves(spark, f"{path}/_new-{run}", depth):
        fs, p = folder(spark, path + leaf)
        if fs.exists(p):
            move(spark, path + leaf, f"{path}/_old-{run}{leaf}")
        move(spark, f"{path}/_new-{run}{leaf}", path + leaf)
    delete(spark, f"{path}/_old-{run}")
    delete(spark, f"{path}/_new-{run}")
