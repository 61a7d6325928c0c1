"""Mergeable quantile sketches as sparse tables of bins (AGG21 to AGG24, AGG26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT, REACH, WIDTH, BINS = 1e-4, 15.0, 0.0005, 60_000


def bin_of(x: Column) -> Column:
    """asinh-spaced bin; -1 and BINS hold what lies beyond. By the size of x: Spark's asinh of -70,000 is off by some 1e-6."""
    at = F.floor((F.signum(x) * F.asinh(F.abs(x) / UNIT) + REACH) / WIDTH)
    return F.when(at < 0, -1).when(at >= BINS, BINS).otherwise(at).cast("int")


def sketch(values: DataFrame, by: list[str], x: str = "x") -> DataFrame:
    """AGG21: (by, bin, n); partial aggregation is the merge."""
    return values.filter(~F.isnan(x) & F.col(x).isNotNull()).groupBy(*by, bin_of(F.col(x)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    """AGG22."""
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    by = [c for c in out.columns if c != "n"]
    return out.groupBy(*by).agg(F.sum("n").alias("n"))


def quantiles(sketched: DataFrame, by: list[str], qs: list[float]) -> DataFrame:
    """AGG23: (by, q, value): the first bin whose running count reaches q of the total, linear inside."""
    w = Window.partitionBy(*by)
    run = sketched.withColumn("cum", F.sum("n").over(w.orderBy("bin"))).withColumn("total", F.sum("n").over(w))
    each = run.withColumn("q", F.explode(F.array(*map(F.lit, qs)))).withColumn("target", F.col("q") * F.col("total")).filter(F.col("cum") >= F.col("target"))
    least = each.groupBy(*by, "q").agg(F.min_by(F.struct("bin", "n", "cum", "target"), "bin").alias("b"))
    inside = (F.col("b.target") - (F.col("b.cum") - F.col("b.n"))) / F.col("b.n")
    y = F.when(F.col("b.bin") < 0, -REACH).when(F.col("b.bin") >= BINS, REACH).otherwise(-REACH + (F.col("b.bin") + inside) * WIDTH)
    return least.select(*by, "q", (F.sinh(y) * UNIT).alias("value"), F.col("b.bin").alias("bin"))


def center_scale(sketched: DataFrame, by: list[str]) -> DataFrame:
    """AGG24: median, and the larger of IQR / 1.349 and (q99 - q1) / 4.6527; a spread inside one bin is no spread."""
    q = quantiles(sketched, by, [0.01, 0.25, 0.5, 0.75, 0.99])
    at = lambda p, c="value": F.max(F.when(F.col("q") == p, F.col(c)))
    wide = q.groupBy(*by).agg(at(0.5).alias("center"), F.when(at(0.25, "bin") != at(0.75, "bin"), (at(0.75) - at(0.25)) / 1.349).alias("iqr"), F.when(at(0.01, "bin") != at(0.99, "bin"), (at(0.99) - at(0.01)) / 4.6527).alias("tails"))
    scale = F.greatest("iqr", "tails")
    return wide.select(*by, "center", F.when(scale.isNull(), F.raise_error(F.lit("no spread"))).otherwise(scale).alias("scale"))
