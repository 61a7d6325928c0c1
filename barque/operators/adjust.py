"""Corporate events, total return, vendor cross-checks (JN1 to JN5, AGG18 to AGG20, WIN12, WIN13, WIN27, WIN28)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OVERLAP, TOLERANCE = 60, 0.25


def of_times(rows: DataFrame, times: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """rows with the columns of the one row of times at their key and ts, null keys and times too; rows without one go."""
    names = {c: f"__{c}" for c in (*key, "ts")}
    on = [F.col(c).eqNullSafe(F.col(t)) for c, t in names.items()]
    return rows.join(times.select(*(F.col(c).alias(t) for c, t in names.items()), *columns), on).drop(*names.values())


def forward_asof(events: DataFrame, bars: DataFrame, key: list[str]) -> DataFrame:
    """JN3: each event's first bar at or after it; events after the last bar go. By union and a window, no range join. The
    window holds the times of a series, not its events; these meet their times in a join."""
    e = events.select(*key, "ts").distinct().withColumn("is_bar", F.lit(0))
    b = bars.select(*key, "ts", F.lit(1).alias("is_bar"))
    # backwards, as a frame that ends with the partition is summed up anew for each row; at equal times the bar comes first
    w = Window.partitionBy(*key).orderBy(F.desc("ts"), F.desc("is_bar")).rowsBetween(Window.unboundedPreceding, 0)
    both = e.unionByName(b).withColumn("bar_ts", F.last(F.when(F.col("is_bar") == 1, F.col("ts")), ignorenulls=True).over(w))
    placed = of_times(events.select(*key, "ts", "value"), both.filter("is_bar = 0 and bar_ts is not null"), key, ["bar_ts"])
    return placed.select(*key, F.col("ts").alias("event_ts"), "bar_ts", "value")


def split_factor(dividends: DataFrame, splits: DataFrame, key: list[str]) -> DataFrame:
    """JN5: product of the ratios of splits strictly after each dividend."""
    factors = time_factors(dividends.select(*key, "ts").distinct(), splits, key)
    return of_times(dividends.select(*key, "ts", "value"), factors, key, ["factor"]).select(*key, "ts", "value", "factor")


def time_factors(times: DataFrame, splits: DataFrame, key: list[str]) -> DataFrame:
    """times (one row a key and ts) with the product of the ratios of splits strictly after them. Splits of one time are
    multiplied before the window over the union of both, which so holds the times of a series and not its splits."""
    s = splits.groupBy(*key, "ts").agg(F.product("value").alias("__ratio")).withColumn("is_div", F.lit(0))
    # backwards; at equal times the dividend comes first, so the split isn't after it
    w = Window.partitionBy(*key).orderBy(F.desc("ts"), F.desc("is_div")).rowsBetween(Window.unboundedPreceding, -1)
    both = times.withColumn("is_div", F.lit(1)).unionByName(s, allowMissingColumns=True)
    return both.withColumn("factor", F.coalesce(F.product("__ratio").over(w), F.lit(1.0))).filter("is_div = 1").drop("is_div", "__ratio")


def total_return(bars: DataFrame, dividends: DataFrame, key: list[str], splits: DataFrame | None = None) -> DataFrame:
    """WIN27, WIN28: close, and tr_close with dividends reinvested: tr_t = tr_(t-1) (c_t + d_t) / c_(t-1). With splits, a dividend is
    divided by the ratios of the splits after it. Dividends of one time are summed up first; bars and dividends meet in one
    union, so the bars are read once and everything from there on stays partitioned by the key."""
    dividends = dividends.groupBy(*key, "ts").agg(F.sum(F.col("value").cast("double")).alias("value"))
    if splits is not None:
        dividends = time_factors(dividends, splits, key).withColumn("value", F.col("value") / F.col("factor"))
    e = dividends.select(*key, "ts", F.lit(0).alias("is_bar"), F.lit(None).cast("double").alias("close"), F.col("value").cast("double").alias("value"))
    b = bars.select(*key, "ts", F.lit(1).alias("is_bar"), F.col("close").cast("double").alias("close"), F.lit(None).cast("double").alias("value"))
    down = Window.partitionBy(*key).orderBy(F.desc("ts"), F.desc("is_bar")).rowsBetween(Window.unboundedPreceding, 0)
    placed = e.unionByName(b).withColumn("bar_ts", F.last(F.when(F.col("is_bar") == 1, F.col("ts")), ignorenulls=True).over(down)).filter("bar_ts is not null")
    rows = placed.groupBy(*key, F.col("bar_ts").alias("ts")).agg(F.max("close").alias("close"), F.sum("value").alias("d"))
    w = Window.partitionBy(*key).orderBy("ts")
    rows = rows.withColumn("before", F.lag("close").over(w))
    step = F.when(F.col("before").isNull(), 1.0).when(F.col("before") == 0, F.raise_error(F.lit("zero close"))).otherwise((F.col("close") + F.coalesce("d", F.lit(0.0))) / F.col("before"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("step", step).select(*key, "ts", "close", (F.first("close").over(upto) * F.product("step").over(upto)).alias("tr_close"))


def close_agreement(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """JN1, AGG18: vendors' closes on shared times."""
    rows = a.select(*key, "ts", F.col("close").alias("a")).join(b.select(*key, "ts", F.col("close").alias("b")), [*key, "ts"]).filter("a > 0 and b > 0")
    diff = F.abs(F.col("a") - F.col("b")) / F.col("b")
    out = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("shared"), F.max(diff).alias("max_diff"), F.percentile(diff, 0.5).alias("median_diff"), F.corr("a", "b").alias("corr"))
    return out.withColumn("status", F.when(F.col("shared") < OVERLAP, "skipped").otherwise("compared"))


def split_discontinuity(bars: DataFrame, splits: DataFrame, key: list[str]) -> DataFrame:
    """AGG19: last close before over first close from the split on; adjusted if it is about 1."""
    b = bars.select(*key, "ts", F.lit(1).alias("is_bar"), F.struct("close").alias("bar"))
    both = splits.select(*key, "ts").distinct().withColumn("is_bar", F.lit(0)).unionByName(b, allowMissingColumns=True)
    # at equal times the bar stands after the split
    before = F.last("bar", ignorenulls=True).over(Window.partitionBy(*key).orderBy("ts", "is_bar").rowsBetween(Window.unboundedPreceding, -1))
    after = F.last("bar", ignorenulls=True).over(Window.partitionBy(*key).orderBy(F.desc("ts"), F.desc("is_bar")).rowsBetween(Window.unboundedPreceding, -1))
    rows = both.withColumns({"b": before.getField("close"), "a": after.getField("close")}).filter("is_bar = 0").withColumnRenamed("ts", "split_ts")
    out = rows.withColumn("ratio", F.when(F.col("a") > 0, F.round(F.col("b") / F.col("a"), 4)))
    return out.select(*key, "split_ts", "ratio", F.when(F.col("ratio").isNull(), "inconclusive").when(F.abs(F.col("ratio") - 1) <= TOLERANCE, "adjusted").otherwise("unadjusted").alias("verdict"))


def seam_merge(parts: DataFrame, key: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """WIN12: overlapping archives to one row per time, and the times on which they disagree (Spark's NaN equals NaN)."""
    row = F.struct(*values)
    grouped = parts.groupBy(*key, "ts").agg(F.min_by(row, "source_rank").alias("r"), F.count_distinct(F.to_json(row)).alias("kinds"))
    return grouped.select(*key, "ts", "r.*"), grouped.filter("kinds > 1").select(*key, "ts", "kinds")


def splice(prior: DataFrame, fresh: DataFrame, key: list[str]) -> DataFrame:
    """WIN13: the fresh row wins on a shared time."""
    both = prior.withColumn("version", F.lit(0)).unionByName(fresh.withColumn("version", F.lit(1)))
    rest = [c for c in both.columns if c not in (*key, "ts", "version")]
    return both.groupBy(*key, "ts").agg(F.max_by(F.struct(*rest), "version").alias("r")).select(*key, "ts", "r.*")


def split_probes(probes: DataFrame, bars: DataFrame, key: list[str]) -> DataFrame:
    """JN10: known splits (key, ts, and the ratio expected) against the stored series: missing where there is no such
    series, else the verdict of `split_discontinuity`."""
    found = split_discontinuity(bars.join(probes.select(*key).distinct(), key, "left_semi"), probes, key).withColumnsRenamed({"split_ts": "ts", "ratio": "measured"})
    there = bars.select(*key).distinct().withColumn("__there", F.lit(True))
    rows = probes.join(there, key, "left").join(found, [*key, "ts"], "left")
    return rows.withColumn("verdict", F.when(F.col("__there").isNull(), "missing").otherwise(F.col("verdict"))).withColumn("measured", F.when(F.col("__there").isNotNull(), F.col("measured"))).drop("__there")


def feed_diff(ours: DataFrame, theirs: DataFrame, key: list[str], values: str | list[str]) -> DataFrame:
    """JN2: full outer difference inside the window of theirs: missing, extra or another value, with the columns that
    differ. Values are compared as they are; null equals null and NaN NaN."""
    values = [values] if isinstance(values, str) else values
    window = theirs.groupBy(*key).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    mine = ours.select(*key, "ts", F.struct(*values).alias("mine")).join(window, key).filter("ts between lo and hi").drop("lo", "hi")
    both = mine.join(theirs.select(*key, "ts", F.struct(*values).alias("other")), [*key, "ts"], "full_outer")
    differ = F.filter(F.array(*(F.when(~F.col(f"mine.{v}").eqNullSafe(F.col(f"other.{v}")), v) for v in values)), lambda v: v.isNotNull())
    both = both.withColumn("columns", F.when(F.col("mine").isNotNull() & F.col("other").isNotNull(), differ).otherwise(F.array().cast("array<string>")))
    kind = F.when(F.col("mine").isNull(), "missing").when(F.col("other").isNull(), "extra").when(F.size("columns") > 0, "value")
    return both.withColumn("kind", kind).filter("kind is not null").select(*key, "ts", "kind", "columns")
