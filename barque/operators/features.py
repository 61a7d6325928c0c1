"""Causal features per bar (WIN14 to WIN20), their inverse (WIN21, WIN22), refusals and scaling."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAST = 256
CLIP = 5.0
PRICES = {"geo": ("gap", "body", "upper", "lower"), "ret": ("ret_open", "ret_high", "ret_low", "ret_close")}
FLOWS = ("rel_volume", "rel_amount")


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))


def log_ratio(a: str, b: str) -> Column:
    """ln(a / b) as of IEEE numbers: prices of zero give infinities, neither null nor an error; 0 / 0 is no number."""
    x, y, inf, nan = F.col(a), F.col(b), F.lit(float("inf")), F.lit(float("nan"))
    r = F.try_divide(x, y)
    by_zero = F.when(x.isNull() | F.isnan(x) | (x <= 0), F.when(x.isNotNull(), nan)).otherwise(inf)
    return F.when(y == 0, by_zero).when(r == 0, -inf).when(r < 0, nan).otherwise(F.ln(r))


def refusals(bars: DataFrame, key: list[str], zero_prices: bool = False) -> DataFrame:
    """WIN19: segments that may not be transformed, with the first failing code; never repaired. zero_prices: prices of zero
    are let through; their logarithms are infinities, which the clip bounds."""
    w = Window.partitionBy(*key).orderBy("row")
    numbers = [F.col(c) for c in ("open", "high", "low", "close", "volume", "amount")]
    tests = {
        "too_short": F.count(F.lit(1)) < 2,
        "non_finite": F.count_if(~F.least(*(F.coalesce(finite(c), F.lit(False)) for c in numbers))) > 0,
        "non_positive_price": F.count_if(F.least(*numbers[:4]) < 0 if zero_prices else F.least(*numbers[:4]) <= 0) > 0,
        "negative_flow": F.count_if(F.least(*numbers[4:]) < 0) > 0,
        "ts_not_increasing": F.count_if(F.col("ts") <= F.col("before")) > 0,
        "ohlc_inconsistent": F.count_if((F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close"))) > 0,
    }
    code = F.coalesce(*(F.when(c, F.lit(r)) for r, c in tests.items()))
    return bars.withColumn("before", F.lag("ts").over(w)).groupBy(*key).agg(code.alias("code")).filter("code is not null")


def _past_medians(key: list[str], columns: tuple[str, ...]):
    """Rows come sorted by key and time. A batch holds whole segments and the ends of two; of the last one the PAST rows are
    kept that the next batch looks back to."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for pdf in frames:
            if pdf.empty:
                continue
            rows = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            of = (rows[key] != rows[key].shift(1)).any(axis=1).cumsum()
            for c in columns:
                before = rows.groupby(of)[c].shift(1)
                rows[f"past_{c}"] = before.groupby(of).rolling(PAST, min_periods=1).median().reset_index(level=0, drop=True)
            yield rows.iloc[len(rows) - len(pdf) :]
            last = rows[of == of.iloc[-1]]
            tail = last.iloc[-PAST:][list(pdf.columns)].copy()

    return task


def raw_features(bars: DataFrame, key: list[str]) -> DataFrame:
    """WIN14 to WIN17: both price sets and the flows of rows 1.. of every segment; row 0 is only the anchor.

    One shuffle: the window deals out segments and sorts them, and the strictly past median reads its rows on in that order,
    batch by batch, so that no task holds a segment whole; the rest are window expressions.
    """
    w = Window.partitionBy(*key).orderBy("ts")
    rows = bars.select(*key, "ts", "open", "high", "low", "close", F.lag("close").over(w).alias("before"), F.log1p("volume").alias("lv"), F.log1p("amount").alias("la"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", past_lv double, past_la double"
    rows = rows.sortWithinPartitions(*key, "ts").mapInPandas(_past_medians(key, ("lv", "la")), schema)
    out = rows.filter("before is not null")
    return out.select(
        *key, "ts", log_ratio("open", "before").alias("gap"), log_ratio("close", "open").alias("body"), log_ratio("high", "open").alias("upper"), log_ratio("low", "open").alias("lower"),
        *(log_ratio(c, "before").alias(f"ret_{c}") for c in ("open", "high", "low", "close")), (F.col("lv") - F.col("past_lv")).alias("rel_volume"), (F.col("la") - F.col("past_la")).alias("rel_amount"),
    )


def long_features(raw: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    return raw.select(*key, "ts", F.inline(F.array(*(F.struct(F.lit(n).alias("feature"), F.col(n).alias("x")) for n in names))))


def scaled(long: DataFrame, constants: DataFrame, by: list[str]) -> DataFrame:
    """WIN18, JN11: (x - center) / scale in [-CLIP, CLIP] as float32; a feature without constants is an error."""
    joined = long.join(constants, [*by, "feature"], "left")
    z = F.when(F.col("scale").isNull(), F.raise_error(F.lit("no constants for a feature"))).otherwise((F.col("x") - F.col("center")) / F.col("scale"))
    joined = joined.withColumn("z", z)
    return joined.withColumn("clipped", F.abs("z") > CLIP).withColumn("z", F.greatest(F.least("z", F.lit(CLIP)), F.lit(-CLIP)).cast("float"))


def leaky_zscore(long: DataFrame, key: list[str]) -> DataFrame:
    """WIN20: baseline over the whole segment (population deviation; 0 becomes 1). Not causal."""
    w = Window.partitionBy(*key, "feature")
    spread = F.stddev_pop("x").over(w)
    return long.withColumn("z", (F.col("x") - F.avg("x").over(w)) / F.when(spread == 0, 1.0).otherwise(spread))


def inverse_prices(raw: DataFrame, anchors: DataFrame, key: list[str]) -> DataFrame:
    """WIN21: closes by the running sum of gap + body from the anchor's close; high and low clamped to the body."""
    w = Window.partitionBy(*key).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    rows = raw.join(anchors.select(*key, F.col("close").alias("anchor_close")), key)
    moved = F.sum(F.col("gap") + F.col("body"))
    before = F.coalesce(moved.over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))  # c - body is no number where a close is 0
    rows = rows.withColumn("c", F.ln("anchor_close") + moved.over(w)).withColumn("o", F.ln("anchor_close") + before + F.col("gap"))
    o, c = F.exp("o"), F.exp("c")
    return rows.select(*key, "ts", o.alias("open"), F.greatest(F.exp(F.col("o") + F.col("upper")), o, c).alias("high"), F.least(F.exp(F.col("o") + F.col("lower")), o, c).alias("low"), c.alias("close"))


class PastMedian:
    """Median of the last `window` numbers: they stand in a sorted list, where one is put in and one taken out by bisection,
    and in a ring in the order in which they came."""

    def __init__(self, window: int = PAST):
        self.window, self.ring, self.sorted = window, deque(), []

    def add(self, x: float) -> None:
        if len(self.ring) == self.window:
            del self.sorted[bisect_left(self.sorted, self.ring.popleft())]
        self.ring.append(x)
        insort(self.sorted, x)

    def median(self) -> float:
        n = len(self.sorted)
        return self.sorted[n // 2] if n % 2 else (self.sorted[n // 2 - 1] + self.sorted[n // 2]) / 2


def undone_flow(feature: np.ndarray, first: float) -> np.ndarray:
    """Values whose logarithms less the median of those before them are `feature`; `first` is the logarithm of the one
    before. Each needs the ones before it."""
    past, out = PastMedian(), np.empty(len(feature))
    past.add(float(first))
    for i, x in enumerate(feature.tolist()):
        y = out[i] = x + past.median()
        past.add(y)
    return np.maximum(np.expm1(out), 0)


def inverse_flows(raw: DataFrame, anchors: DataFrame, key: list[str]) -> DataFrame:
    """WIN22: y_t = feature_t + median of the past y; a recursion, so one grouped map per segment. key names a segment,
    which bounds a group."""
    rows = raw.join(anchors.select(*key, F.log1p("volume").alias("v0"), F.log1p("amount").alias("a0")), key)

    def per_segment(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        for feature, start, out in (("rel_volume", "v0", "volume"), ("rel_amount", "a0", "amount")):
            pdf[out] = undone_flow(pdf[feature].to_numpy(), pdf[start].iloc[0])
        return pdf[[*key, "ts", "volume", "amount"]]

    kinds = ", ".join(f"{k} {dict(raw.dtypes)[k]}" for k in key)
    return rows.select(*key, "ts", "rel_volume", "rel_amount", "v0", "a0").groupBy(*key).applyInPandas(per_segment, f"{kinds}, ts long, volume double, amount double")
