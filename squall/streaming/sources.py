"""Stream sources: Kafka topics and file drop folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from squall.functions.parsing import parse_json_column


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", **options) -> DataFrame:
    """Subscribe to one topic.  The envelope columns (topic, partition,
    offset, timestamp, key, value) are kept; offsets live in the query's
    checkpoint, which replaces consumer-group offsets; lost offsets fail the
    query (Spark's default) unless ``failOnDataLoss`` is passed.  Needs the Kafka
    connector on the classpath (not bundled here, so untested)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def parse_kafka_json(raw: DataFrame, schema: StructType,
                     keep_envelope: bool = False) -> DataFrame:
    """Kafka records (binary ``value`` + envelope) -> typed message columns;
    with ``keep_envelope`` also topic, partition, offset and the record time
    (as ``kafka_timestamp``, since messages often have their own
    ``timestamp`` field)."""
    if not keep_envelope:
        return parse_json_column(raw, schema)
    raw = raw.withColumnRenamed("timestamp", "kafka_timestamp")
    return parse_json_column(raw, schema,
                             keep=("topic", "partition", "offset", "kafka_timestamp"))


def kafka_json_stream(spark: SparkSession, servers: str, topic: str, schema: StructType,
                      starting_offsets: str = "latest", keep_envelope: bool = False,
                      **options) -> DataFrame:
    """Topic of JSON messages -> typed columns (plus the envelope if asked)."""
    raw = kafka_stream(spark, servers, topic, starting_offsets, **options)
    return parse_kafka_json(raw, schema, keep_envelope)


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder as a stream (files already present are read by
    the first micro-batch)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def event_time_to_timestamp(df: DataFrame, col: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ) event times."""
    return df.withColumn(col, F.col(col).cast("timestamp"))
