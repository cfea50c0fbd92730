"""Stream sinks and the runner used by the registered streaming queries.

* ``to_kafka`` / ``to_console``: the production sinks of the jobs.
* ``run_append_to_table``: append-mode stream into a Parquet folder with
  Spark's file sink (exactly-once through its commit log).
* ``run_updates_to_table``: update-mode stream through ``foreachBatch``;
  every micro-batch overwrites its own ``_epoch`` partition, so a retried
  batch replaces its earlier attempt instead of duplicating it.
  ``latest_updates`` then keeps the newest row per key.

All checkpoints and tables live in the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from squall.session import scratch_path


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
             query_name: str | None = None) -> StreamingQuery:
    """Rows as JSON objects in ``value`` to a topic, append mode."""
    out = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    writer = (out.writeStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("topic", topic)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def batch_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Finite rows to a topic (the producer batches records itself)."""
    (df.select(F.to_json(F.struct(*df.columns)).alias("value"))
       .write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())


def to_console(df: DataFrame, mode: str = "append", query_name: str | None = None,
               checkpoint: str | None = None,
               processing_time: str | None = None) -> StreamingQuery:
    writer = (df.writeStream.format("console").outputMode(mode)
              .option("truncate", "false"))
    if query_name:
        writer = writer.queryName(query_name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_append_to_table(df: DataFrame, name: str, partition_cols=(),
                        fmt: str = "parquet", available_now: bool = True) -> str:
    """Run an append-mode stream into a fresh folder; return the folder."""
    spark = df.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("path", f"{base}/data")
              .option("checkpointLocation", f"{base}/checkpoint")
              .queryName(f"{name}_{base[-12:]}"))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return f"{base}/data"


def run_updates_to_table(df: DataFrame, name: str, available_now: bool = True) -> str:
    """Run an update-mode stream; each micro-batch lands in ``_epoch=N``."""
    spark = df.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    data = f"{base}/data"

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{data}/_epoch={epoch_id}")

    writer = (df.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", f"{base}/checkpoint")
              .queryName(f"{name}_{base[-12:]}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return data


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest emitted row per key across the micro-batch partitions."""
    df = spark.read.parquet(path)
    values = [c for c in df.columns if c not in keys and c != "_epoch"]
    newest = F.max_by(F.struct(*values), F.col("_epoch"))
    return df.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")


def fan_out(*writers):
    """One ``foreachBatch`` function feeding several stateless outputs from
    a single read of the source: the micro-batch is cached once, handed to
    each ``writer(batch, epoch_id)``, then released."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for w in writers:
                w(batch, epoch_id)
        finally:
            batch.unpersist()
    return write_batch


def kafka_batch_writer(servers: str, topic: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch_to_kafka(batch, servers, topic)
    return write


def console_batch_writer(rows: int = 20):
    def write(batch: DataFrame, epoch_id: int) -> None:
        print(f"-- batch {epoch_id}")
        batch.show(rows, truncate=False)
    return write
