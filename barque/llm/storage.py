"""Shared-folder tables that cut lineage: written once, read by every executor, safe to lose executors over."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local master (tests) gets one of our own; a cluster,
    whose nodes share no local folder, gets an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        at = f"file://{tempfile.mkdtemp(prefix='barque-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/barque/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of tables that `stored` returned, once nothing reads them any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
