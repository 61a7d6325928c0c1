"""Publication in two phases: stage, validate what was staged, swap (SNK3, SNK4, SNK6).

The new index is written beside the old one and read back there; only a sound one is renamed into place, and the version
that it replaces stays beside it. A run that is refused or dies before the swap leaves the old index byte for byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STAGING, PREVIOUS = ".staging-", ".previous"


class Refused(ValueError):
    """What was staged may not be published."""


class _Folders:
    """The file system of a path, whatever its scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} was not renamed to {new}")

    def matching(self, pattern: str) -> list[str]:
        return [x.getPath().toString() for x in self.fs.globStatus(self._path(pattern)) or []]


def replace(new: DataFrame, path: str, validate: Callable[[DataFrame], None], options: dict[str, str] | None = None) -> None:
    """Put `new` at path, if `validate` finds nothing to refuse in what was written."""
    spark, path = new.sparkSession, path.rstrip("/")
    folders, staged = _Folders(spark, path), f"{path}{STAGING}{uuid.uuid4().hex}"
    try:
        new.write.options(**(options or {})).parquet(staged)
        validate(spark.read.schema(new.schema).parquet(staged))
    except BaseException:
        folders.delete(staged)
        raise
    before = f"{path}{PREVIOUS}"
    if folders.exists(path):
        folders.delete(before)
        folders.rename(path, before)
    try:
        folders.rename(staged, path)
    except OSError:
        if folders.exists(before):
            folders.rename(before, path)
        raise


def rolled_back(spark: SparkSession, path: str) -> None:
    """The version before becomes the published one again."""
    path = path.rstrip("/")
    folders = _Folders(spark, path)
    if not folders.exists(f"{path}{PREVIOUS}"):
        raise Refused("no version to go back to")
    aside = f"{path}{STAGING}{uuid.uuid4().hex}"
    if folders.exists(path):
        folders.rename(path, aside)
    folders.rename(f"{path}{PREVIOUS}", path)
    folders.delete(aside)


def abandoned(spark: SparkSession, path: str) -> list[str]:
    """Staging folders that runs that died have left beside path."""
    return _Folders(spark, path).matching(f"{path.rstrip('/')}{STAGING}*")


def broken_segments(segs: DataFrame, key: list[str]) -> DataFrame:
    """Segments that begin before the one before them ends, or whose id stands twice."""
    w = Window.partitionBy(*key).orderBy("start_ts", "end_ts")
    overlap = F.coalesce(F.col("start_ts") <= F.lag("end_ts").over(w), F.lit(False))
    twice = segs.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("segment_id", F.lit("twice").alias("fault"))
    return segs.withColumn("o", overlap).filter("o").select("segment_id", F.lit("overlap").alias("fault")).unionByName(twice)


def publish(segs: DataFrame, key: list[str], path: str) -> None:
    """SNK3: put a segment index at path; refused if segments overlap or stand twice."""

    def sound(staged: DataFrame) -> None:
        found = broken_segments(staged, key).orderBy("segment_id", "fault").limit(5).collect()  # a few to name
        if found:
            raise Refused("segments overlap or stand twice: " + ", ".join(f"{r.segment_id} ({r.fault})" for r in found))

    replace(segs, path, sound)


def may_replace(index: DataFrame, partial: bool, forced: bool = False) -> bool:
    """SNK4: whether a run may replace an index (with a column `partial`): a partial run never replaces a full one, unless
    forced. An empty index may always be replaced."""
    return forced or not partial or index.filter("not partial").isEmpty()


def write_index(spark: SparkSession, new: DataFrame, path: str, partial: bool, forced: bool = False) -> None:
    """SNK4: put segments at path as an index, behind `may_replace`."""
    if _Folders(spark, path).exists(path) and not may_replace(spark.read.parquet(path), partial, forced):
        raise Refused("a partial run would replace the full index")
    replace(new.withColumn("partial", F.lit(partial)), path, lambda staged: None)
