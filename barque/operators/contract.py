"""Whole tables through a feature contract and back, by a spec (WIN18 to WIN23, JN11, AGG26).

A spec names six features, their clip and the slices that scale them. Segments that break the contract come out as rows of
their own; everything else is one wide float32 row a bar. What the clip moved is observed in the pass that writes the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from barque.operators import features, runs
from barque.operators.features import FLOWS, PRICES
from barque.operators.sketch import center_scale, quantiles, sketch

NEEDED = {"ts": "bigint"} | dict.fromkeys(("open", "high", "low", "close", "volume", "amount"), "double")
MOST_SLICES = 10_000  # rows of constants that every task gets
#: The quantiles of a distribution table.
REPORT = (0.001, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999)


class ContractError(ValueError):
    def __init__(self, code: str, why: str):
        super().__init__(f"{code}: {why}")
        self.code = code


@dataclass(frozen=True)
class Spec:
    """leaky: scaled by the segment's own mean and deviation, so not causal and not to be undone."""

    name: str
    prices: str
    low: float = -5.0
    high: float = 5.0
    leaky: bool = False
    features: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "features", (*PRICES[self.prices], *FLOWS))


GEO, RET, WINDOW_SCORE = Spec("geo-v1", "geo"), Spec("ret-v1", "ret"), Spec("zscore-v1", "ret", leaky=True)


def check_columns(bars: DataFrame) -> None:
    """WIN19: a table without a needed column, or with one of another type, is refused whole."""
    have = dict(bars.dtypes)
    if missing := [c for c in NEEDED if c not in have]:
        raise ContractError("missing_column", ", ".join(missing))
    if other := [f"{c} is {have[c]}" for c in NEEDED if have[c] != NEEDED[c]]:
        raise ContractError("bad_dtype", ", ".join(other))


def wide(constants: DataFrame, spec: Spec, by: list[str]) -> DataFrame:
    """One row a slice with the spec's centers and scales; a slice without one of its features is an error."""
    rows = constants.filter(F.col("feature").isin(*spec.features))
    if rows.count() > MOST_SLICES:
        raise ContractError("too_many_constants", f"over {MOST_SLICES} rows")
    of = lambda c: F.map_from_entries(F.collect_list(F.struct("feature", c)))
    rows = rows.groupBy(*by).agg(of("center").alias("__center"), of("scale").alias("__scale")).filter(F.size("__center") > 0)
    whole = F.size(F.map_keys("__center")) == len(spec.features)
    return rows.withColumn("__center", F.when(whole, F.col("__center")).otherwise(runs.refuse("a slice lacks a feature").cast("map<string,double>")))


def _constants(rows: DataFrame, constants: DataFrame | None, spec: Spec, by: list[str]) -> DataFrame:
    if constants is None:
        raise ContractError("missing_constants", f"{spec.name} needs a table of constants")
    table = wide(constants, spec, by)
    joined = rows.join(F.broadcast(table), by, "left") if by else rows.join(F.broadcast(table), F.lit(True), "left")  # one row without slices
    known = F.when(F.col("__center").isNull(), runs.refuse("missing_constants: a slice has none").cast("map<string,double>")).otherwise(F.col("__center"))
    return joined.withColumn("__center", known)


@dataclass
class Transformed:
    """rows: key, by, ts and the spec's features as float32. refused: key and code. clips: after an action on rows, the values
    that the clip moved by feature, rows, and values that are no number (nans)."""

    rows: DataFrame
    refused: DataFrame
    clips: Observation
    spec: Spec


def transform(bars: DataFrame, spec: Spec, constants: DataFrame | None, key: list[str], by: list[str] | None = None, allow_leaky: bool = False, zero_prices: bool = False) -> Transformed:
    """Segments to feature rows. bars: key (a segment), by (the slice of its constants; bars of a segment share one), ts and
    the six values, in the order of `row`, or of ts where there is no such column. The first bar of a segment is its anchor
    and has no row. zero_prices: as of features.refusals, here and below; infinities count among the clips, not the nans."""
    by = by or []
    check_columns(bars)
    if spec.leaky and not allow_leaky:
        raise ContractError("leaky_spec", f"{spec.name} scales a segment by itself; allow_leaky=True means to")
    ordered = bars if "row" in bars.columns else bars.withColumn("row", F.col("ts"))
    refused = features.refusals(ordered, key, zero_prices)
    good = bars.join(refused.select(*key), key, "left_anti")
    raw = features.raw_features(good, [*by, *[k for k in key if k not in by]])
    if spec.leaky:
        w = Window.partitionBy(*key)
        z = {f: (F.col(f) - F.avg(f).over(w)) / F.when(F.stddev_pop(f).over(w) == 0, 1.0).otherwise(F.stddev_pop(f).over(w)) for f in spec.features}
        scored = raw.select(*by, *[k for k in key if k not in by], "ts", *(c.alias(f) for f, c in z.items()))
    else:
        joined = _constants(raw, constants, spec, by)
        z = {f: (F.col(f) - F.col("__center")[f]) / F.col("__scale")[f] for f in spec.features}
        scored = joined.select(*by, *[k for k in key if k not in by], "ts", *(c.alias(f) for f, c in z.items()))
    clips = Observation(f"clips of {spec.name}")
    moved = lambda f: (F.col(f) < spec.low) | (F.col(f) > spec.high)
    nan = sum((F.when(number(F.col(f), zero_prices), 0).otherwise(1) for f in spec.features), F.lit(0))
    scored = scored.observe(clips, F.count(F.lit(1)).alias("rows"), *(F.count_if(moved(f)).alias(f) for f in spec.features), F.sum(nan).alias("nans"))
    return Transformed(scored.withColumns({f: F.greatest(F.least(f, F.lit(spec.high)), F.lit(spec.low)).cast("float") for f in spec.features}), refused, clips, spec)


def inverse(rows: DataFrame, anchors: DataFrame, spec: Spec, constants: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """Feature rows back to bars (WIN23): the anchors (key, ts and the six values) as they are and a bar for each row, its
    trade columns null. A segment without an anchor is an error, and so are rows of a spec that can't be undone."""
    by = by or []
    if spec.leaky:
        raise ContractError("leaky_spec", f"{spec.name} keeps no statistics to undo it with")
    if missing := [f for f in spec.features if f not in rows.columns]:
        raise ContractError("bad_shape", f"no {', '.join(missing)}")
    first = F.struct("ts", *(c for c in NEEDED if c != "ts"))
    have = rows.select(*key).distinct()
    known = anchors.join(have, key, "left_semi").groupBy(*key).agg(F.min_by(first, "ts").alias("a")).select(*key, "a.*")
    without = have.join(known.select(*key), key, "left_anti")
    joined = _constants(rows, constants, spec, by)
    raw = joined.select(*key, "ts", *((F.col(f).cast("double") * F.col("__scale")[f] + F.col("__center")[f]).alias(f) for f in spec.features))
    if spec.prices == "ret":  # a close's return is its gap and body; the wicks are told from the open
        raw = raw.withColumns({"gap": F.col("ret_open"), "body": F.col("ret_close") - F.col("ret_open"), "upper": F.col("ret_high") - F.col("ret_open"), "lower": F.col("ret_low") - F.col("ret_open")})
    out = runs.inverse_table(known, features.inverse_prices(raw, known, key), features.inverse_flows(raw, known, key), key)
    error = runs.refuse("missing_anchor: a segment has none")
    return out.unionByName(without.select(*key, *(error.cast(kind).alias(c) for c, kind in out.dtypes if c not in key)))


def number(c: Column, zero_prices: bool) -> Column:
    return ~F.isnan(c) if zero_prices else features.finite(c)


def distribution(long: DataFrame, low: float, high: float, by: list[str], zero_prices: bool = False) -> DataFrame:
    """AGG26: of scaled values before the clip (by, feature, z), by slice and feature: the values, those clipped and their
    rate, those that are no number, and nine quantiles of the clipped values out of a sketch."""
    z = F.col("z")
    good = F.coalesce(number(z, zero_prices), F.lit(False))
    rows = long.select(*by, "feature", F.greatest(F.least(z, F.lit(high)), F.lit(low)).alias("x"), (good & ((z < low) | (z > high))).alias("clipped"), (~good).alias("bad"))
    counts = rows.groupBy(*by, "feature").agg(F.count_if(~F.col("bad")).alias("n"), F.count_if("clipped").alias("clipped"), F.count_if("bad").alias("n_nan"))
    found = quantiles(sketch(rows.filter("not bad"), [*by, "feature"]), [*by, "feature"], list(REPORT))
    at = found.groupBy(*by, "feature").agg(*(F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"q{q:g}") for q in REPORT))
    rate = F.coalesce(F.try_divide("clipped", "n"), F.lit(0.0)).alias("clip_rate")
    return counts.join(at, [*by, "feature"], "left").select(*by, "feature", "n", "clipped", rate, "n_nan", *(f"`q{q:g}`" for q in REPORT))


def flagged(table: DataFrame, by: list[str], most: float = runs.CLIP_RATE) -> DataFrame:
    """AGG27 of a distribution table."""
    return table.filter(F.col("clip_rate") > most).select(*by, "feature", "clip_rate")


def of_specs(bars: DataFrame, specs: tuple[Spec, ...], constants: DataFrame, key: list[str], by: list[str] | None = None, zero_prices: bool = False) -> tuple[DataFrame, DataFrame]:
    """AGG25 to AGG27 over several specs from one set of raw features: (spec, by, feature, z) and the refused segments."""
    by = by or []
    check_columns(bars)
    ordered = bars if "row" in bars.columns else bars.withColumn("row", F.col("ts"))
    refused = features.refusals(ordered, key, zero_prices)
    raw = features.raw_features(bars.join(refused.select(*key), key, "left_anti"), [*by, *[k for k in key if k not in by]])
    long = None
    for spec in specs:
        joined = _constants(raw, constants, spec, by)
        each = F.array(*(F.struct(F.lit(f).alias("feature"), ((F.col(f) - F.col("__center")[f]) / F.col("__scale")[f]).alias("z")) for f in spec.features))
        part = joined.select(F.lit(spec.name).alias("spec"), *by, F.inline(each))
        long = part if long is None else long.unionByName(part)
    return long, refused


def fit(bars: DataFrame, specs: tuple[Spec, ...], key: list[str], by: list[str] | None = None, before_ts: int | None = None, zero_prices: bool = False) -> tuple[DataFrame, DataFrame]:
    """AGG25: constants (spec, by, feature, center, scale) of each slice from the segments' bars before the firewall, out of
    one sketch; and the segments that took no part (key, code): refused by the contract, or behind_firewall. A slice whose
    bars give a feature no spread is an error."""
    by = by or []
    check_columns(bars)
    rows = bars if before_ts is None else bars.filter(F.col("ts") < before_ts)
    ordered = rows if "row" in rows.columns else rows.withColumn("row", F.col("ts"))
    refused = features.refusals(ordered, key, zero_prices)
    left = bars.select(*key).distinct().join(rows.select(*key).distinct(), key, "left_anti").withColumn("code", F.lit("behind_firewall"))
    raw = features.raw_features(rows.join(refused.select(*key), key, "left_anti"), [*by, *[k for k in key if k not in by]])
    names = list(dict.fromkeys(f for spec in specs for f in spec.features))
    found = sketch_constants(features.long_features(raw, by, names), by)
    of = F.array(*(F.struct(F.lit(s.name).alias("spec"), F.array(*map(F.lit, s.features)).alias("names")) for s in specs))
    each = found.select("*", F.inline(of)).filter(F.array_contains("names", F.col("feature")))
    return each.select("spec", *by, "feature", "center", "scale"), refused.select(*key, "code").unionByName(left.select(*key, "code"))


def sketch_constants(long: DataFrame, by: list[str]) -> DataFrame:
    """(by, feature, center, scale) of (by, feature, x); values on a grid of 1e-6, a little off its points, so that a last
    digit can't move one over the edge of a bin."""
    return center_scale(sketch(long.withColumn("x", F.round("x", 6) + 3e-7), [*by, "feature"]), [*by, "feature"])
