"""Bar validation and statistics per series (AGG1 to AGG6, AGG36)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.functions.sessions import closed_window, whole

FLOATS = ("open", "high", "low", "close", "volume", "amount")
LISTED, RECENT = 8, 252


def missing(c: str) -> Column:
    """NaN counts as null."""
    return F.col(c).isNull() | F.isnan(c)


def flags(step_ms: int, key: list[str], daily_exchange: bool = False, closed: bool = False) -> dict[str, tuple[str, Column]]:
    """Rule to (severity, row breaks it). Order of the input is the column `row`."""
    before = F.lag("ts").over(Window.partitionBy(*key).orderBy("row"))
    grid = "violation" if daily_exchange else "warning"
    out = {"null_ts": ("violation", F.col("ts").isNull())} | {f"null_{c}": ("violation", missing(c)) for c in FLOATS}
    out |= {
        "ts_not_increasing": ("violation", F.col("ts") <= before),
        "high_below_open_or_close": ("violation", F.col("high") < F.greatest("open", "close")),
        "low_above_open_or_close": ("violation", F.col("low") > F.least("open", "close")),
        "high_below_low": ("violation", F.col("high") < F.col("low")),
        "volume_negative": ("violation", F.col("volume") < 0),
        "amount_negative": ("violation", F.col("amount") < 0),
        "ts_off_grid": (grid, F.pmod("ts", F.lit(step_ms)) != 0),
    }
    if closed:
        out["bars_in_weekend_close"] = ("warning", closed_window(F.col("ts")))
    return out


def validation_report(bars: DataFrame, key: list[str], step_ms: int, daily_exchange: bool = False, closed: bool = False, expected: DataFrame | None = None) -> DataFrame:
    """AGG1: (key, rule, severity, n, first_row) of every rule that some row breaks. bars needs `row`, its input order.
    expected: the series that there should be; one of them without a row breaks the rule `empty`."""
    rules = flags(step_ms, key, daily_exchange, closed)
    marked = bars.select(*key, "row", *(F.coalesce(c, F.lit(False)).alias(r) for r, (_, c) in rules.items()))
    counted = marked.groupBy(*key).agg(*(x for r in rules for x in (F.count_if(r).alias(f"n_{r}"), F.min(F.when(F.col(r), F.col("row"))).alias(f"first_{r}"))))
    each = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.col(f"n_{r}").alias("n"), F.col(f"first_{r}").alias("first_row")) for r, (s, _) in rules.items()))
    out = counted.select(*key, F.inline(F.filter(each, lambda x: x["n"] > 0)))
    if expected is None:
        return out
    none = expected.select(*key).distinct().join(counted.select(*key), key, "left_anti")
    order = dict(bars.dtypes)["row"]
    return out.unionByName(none.select(*key, F.lit("empty").alias("rule"), F.lit("violation").alias("severity"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(order).alias("first_row")))


def offending_rows(bars: DataFrame, key: list[str], step_ms: int, limit: int = LISTED) -> DataFrame:
    """AGG36: the first rows that break each rule."""
    rules = flags(step_ms, key)
    broken = F.filter(F.array(*(F.when(c, F.lit(r)) for r, (_, c) in rules.items())), lambda x: x.isNotNull())
    rows = bars.withColumn("broken", broken).select(*key, "row", "ts", F.pmod("ts", F.lit(step_ms)).alias("offset_ms"), F.explode("broken").alias("rule"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "rule").orderBy("row"))).filter(F.col("rank") <= limit)


def statistics(bars: DataFrame, key: list[str], step_ms: int) -> DataFrame:
    """AGG2 to AGG6: rows, first and last time, gaps, rows off the grid and in closed hours, median dollar volume of the
    last year's rows."""
    recent = Window.partitionBy(*key).orderBy(F.col("ts").desc())
    dollars = F.col("close") * F.col("volume")
    finite = ~F.isnan(dollars) & (F.abs(dollars) < float("inf"))
    rows = bars.withColumn("back", F.row_number().over(recent))
    n = F.count(F.lit(1))
    gaps = F.when(n < 2, F.lit(0)).otherwise(whole((F.max("ts") - F.min("ts")) / step_ms) + 1 - n).cast("long")
    return rows.groupBy(*key).agg(
        n.alias("row_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), gaps.alias("gap_count"),
        F.count_if(F.pmod("ts", F.lit(step_ms)) != 0).alias("off_grid"), F.count_if(closed_window(F.col("ts"))).alias("closed_window"),
        F.coalesce(F.percentile(F.when((F.col("back") <= RECENT) & finite, dollars), 0.5), F.lit(0.0)).alias("median_dollar_volume"),
    )
