"""Tables that are computed once and then joined.

No side is broadcast by hint: a side read from files has a size that Spark
knows, so its own threshold (``spark.sql.autoBroadcastJoinThreshold``) bounds
what is broadcast, and adaptive execution corrects the choice at run time.
A derived side gets such a size from ``shared_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from squall.session import scratch_path, shared_dir


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage
    (survives executor loss; computed once even if used twice)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back:
    lineage is cut, and joins are planned by the size of its files.  The files
    go when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)
