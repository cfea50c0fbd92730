"""Counts of a stream's messages as a table, one row per micro-batch.

The counts of an epoch go to ``_epoch=N``, which a retry replaces, so no batch
counts twice; totals are sums over the table and survive restarts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "valid long, rejected long, by_reason map<string,long>, _epoch long"


def counted(batch: DataFrame, reason: Column) -> DataFrame:
    """One row: usable messages, rejected ones and these by reason."""
    rows = batch.select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    is_bad = F.col("reason").isNotNull()
    pairs = F.collect_list(F.when(is_bad, F.struct("reason", "n")))  # a handful of reasons
    return rows.agg(F.coalesce(F.sum(F.when(~is_bad, F.col("n"))), F.lit(0)).alias("valid"),
                    F.coalesce(F.sum(F.when(is_bad, F.col("n"))), F.lit(0)).alias("rejected"),
                    F.map_from_entries(pairs).alias("by_reason"))


def write_epoch(counts: DataFrame, path: str, epoch_id: int) -> None:
    counts.write.mode("overwrite").parquet(f"{path}/_epoch={epoch_id}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per epoch its counts, the totals so far and the share of usable
    messages in percent (null without messages)."""
    upto = Window.orderBy("_epoch").rowsBetween(Window.unboundedPreceding, 0)  # a row per epoch
    df = spark.read.schema(SCHEMA).parquet(path)
    df = df.withColumns({"total_valid": F.sum("valid").over(upto), "total_rejected": F.sum("rejected").over(upto)})
    return df.select(F.col("_epoch").alias("epoch"), "valid", "rejected", "by_reason", "total_valid", "total_rejected",
                     F.try_divide(F.col("total_valid") * 100.0, F.col("total_valid") + F.col("total_rejected"))
                     .alias("success_pct"))
