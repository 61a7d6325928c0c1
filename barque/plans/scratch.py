"""Where queries that write files before they read them put those."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A folder that all nodes reach, the same for every call of a query in one application, which writes over it: under
    spark.checkpoint.dir; a local master may lack that and gets one of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        at = f"file://{tempfile.mkdtemp(prefix='barque-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/barque/{spark.sparkContext.applicationId}/{name}"


def emptied(spark: SparkSession, path: str) -> str:
    """The folder without what an earlier call left in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written once and read again, for a query that needs it in several places."""
    at = emptied(df.sparkSession, folder(df.sparkSession, name))
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
