"""File sources: JSON Lines stores, multi-line JSON documents, positional
``{country}/{city}/file`` layouts, and the catalogue of what exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from squall.schemas import STORED_ALERT


def read_json_lines(spark: SparkSession, path: str, schema: StructType,
                    drop_malformed: bool = True, recursive: bool = False) -> DataFrame:
    """Explicit-schema JSON Lines scan; blank and malformed lines are skipped."""
    reader = spark.read.schema(schema)
    if drop_malformed:
        reader = reader.option("mode", "DROPMALFORMED")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path)


def read_json_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file (possibly indented) JSON documents, one row per file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_location_store(spark: SparkSession, path: str, schema: StructType = STORED_ALERT,
                        drop_malformed: bool = True) -> DataFrame:
    """Rows written by ``sinks.files.write_location_store`` (partition
    columns ``country_dir`` / ``city_dir`` are typed as strings)."""
    full = StructType(list(schema.fields) + [StructField("country_dir", StringType()),
                                             StructField("city_dir", StringType())])
    return read_json_lines(spark, path, full, drop_malformed)


def read_positional(spark: SparkSession, base: str, file_name: str, schema: StructType,
                    multi_line: bool = False) -> DataFrame:
    """Files laid out as ``base/{country}/{city}/file_name`` (folder names
    carry the location, not ``key=value``); the names come from the path."""
    glob = f"{base.rstrip('/')}/*/*/{file_name}"
    reader = spark.read.schema(schema)
    reader = reader.option("multiLine", "true") if multi_line \
        else reader.option("mode", "DROPMALFORMED")
    df = reader.json(glob)
    path = F.col("_metadata.file_path")
    pattern = r"/([^/]+)/([^/]+)/[^/]+$"
    return df.withColumns({"country_dir": F.url_decode(F.regexp_extract(path, pattern, 1)),
                           "city_dir": F.url_decode(F.regexp_extract(path, pattern, 2))})


def catalogue(df: DataFrame) -> DataFrame:
    """Which locations have data: distinct folder names, sorted."""
    return df.select("country_dir", "city_dir").distinct().orderBy("country_dir", "city_dir")


def split_store(spark: SparkSession, path: str, schema: StructType = STORED_ALERT) -> tuple[DataFrame, DataFrame]:
    """A location store of JSON Lines as (rows, rejects): lines that are no
    JSON or have a value of the wrong type are kept as ``_raw`` with their
    location instead of being skipped; blank lines are neither."""
    full = StructType([*schema.fields, StructField("_bad", StringType())])
    lines = spark.read.schema("value string, country_dir string, city_dir string").text(path).filter(F.trim("value") != "")
    rows = lines.select("country_dir", "city_dir", F.col("value").alias("_raw"), F.from_json(
        "value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    ok = F.col("r._bad").isNull()
    return (rows.filter(ok).select(*[F.col(f"r.{n}").alias(n) for n in schema.names], "country_dir", "city_dir"),
            rows.filter(~ok).select("country_dir", "city_dir", "_raw"))


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(country_dir, city_dir, file) of every file of a location store, from
    its listing: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")

    def name(i: int):
        part = F.regexp_extract("path", r"/country_dir=([^/]*)/city_dir=([^/]*)/[^/]+$", i)
        return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return files.select(name(1).alias("country_dir"), name(2).alias("city_dir"), F.col("path").alias("file"))


def store_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Which locations a store has files of, sorted; reads the listing only."""
    return catalogue(stored_files(spark, path))


def split_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Daily history JSON Lines as (valid rows with ``date`` typed, rejects).

    A reject has its raw line and a reason: ``malformed`` (no JSON, or a value
    of the wrong type), ``bad_date`` (missing or no date) or
    ``duplicate_day`` (all but the least line of a location's day)."""
    from squall.schemas import DAILY_RAW
    full = StructType([*DAILY_RAW.fields, StructField("_bad", StringType())])
    rows = (spark.read.text(path).filter(F.trim("value") != "")
            .select(F.col("value").alias("_raw"), F.from_json(
                "value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
            .select("_raw", "r.*").withColumn("date", F.col("date").try_cast("date")))
    day = Window.partitionBy("country", "city", "date").orderBy("_raw")
    usable = F.col("_bad").isNull() & F.col("date").isNotNull()
    rows = rows.withColumn("_reason", F.when(F.col("_bad").isNotNull(), "malformed")
                           .when(F.col("date").isNull(), "bad_date"))
    good = rows.filter(usable).withColumn("_reason", F.when(F.row_number().over(day) > 1, "duplicate_day"))
    rejects = (rows.filter(~usable).select("_raw", F.col("_reason").alias("reason"))
               .unionByName(good.filter(F.col("_reason").isNotNull()).select("_raw", F.col("_reason").alias("reason"))))
    return good.filter(F.col("_reason").isNull()).drop("_raw", "_bad", "_reason"), rejects


def load_history(spark: SparkSession, path: str, rejects_path: str | None = None) -> DataFrame:
    """The valid rows of ``split_history``; with ``rejects_path`` the rejects
    are written there, a folder per reason (``rejects_by_reason`` counts
    them)."""
    valid, rejects = split_history(spark, path)
    if rejects_path is not None:
        (rejects.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("reason").parquet(rejects_path))
    return valid


def rejects_by_reason(spark: SparkSession, rejects_path: str) -> DataFrame:
    """(reason, n) of the rejects written by ``load_history``."""
    rows = spark.read.schema("_raw string, reason string").parquet(rejects_path)
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
