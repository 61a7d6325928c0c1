"""Six-stage cleaning of series into segments (WIN1 to WIN10) and its reports (AGG13 to AGG16, AGG29, TOP8),
and the bars of its segments (JN4, FLT9).

All windows are over the series or over pieces of it, so the rows are shuffled once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.functions.sessions import in_session, missing_slots

CONTEXT = 512
RULES = ("session_filter", "gap", "jump", "illiquid", "stagnant", "min_length")


@dataclass(frozen=True)
class Thresholds:
    step_ms: int
    jump: float
    max_illiquid: int
    max_stagnant: int
    min_bars: int
    session: str = "strict"
    epsilon: float = 0.0
    break_hours: tuple[int, int] = (-1, -1)


HOURLY = Thresholds(3_600_000, 0.20, 1, 3, 256)
DAILY = Thresholds(86_400_000, 0.30, 1, 3, 128)


def clean_rows(bars: DataFrame, key: list[str], t: Thresholds) -> DataFrame:
    """Every in-session bar with what became of it.

    Adds cut (gap, jump or null), dropped (illiquid, stagnant, min_length or null), piece (number of the final piece), and
    its pieces before the two excisions (before_illiquid, before_stagnant), sr and er: the reasons that its piece starts or
    ends there. A gap goes before a jump; runs of exactly the limit stay; a
    dropped bar breaks the runs after it.
    """
    series = Window.partitionBy(*key).orderBy("ts")
    upto = series.rowsBetween(Window.unboundedPreceding, 0)
    b = bars.filter(in_session(F.col("ts"), F.col("volume"), t.session, t.step_ms))
    gap = missing_slots(F.col("ts"), F.lag("ts").over(series), F.first("ts").over(upto), t.session, t.step_ms, t.break_hours)
    before = F.lag("close").over(series)
    jump = F.coalesce(F.abs(F.try_divide("open", before) - 1), F.lit(float("inf"))) > t.jump
    fresh = F.lag("ts").over(series).isNull()
    b = b.withColumn("cut", F.when(fresh, F.lit(None).cast("string")).when(gap > 0, "gap").when(jump, "jump"))
    b = b.withColumn("sr", F.when(fresh, "series_start").otherwise(F.col("cut")))
    b = b.withColumn("er", F.when(F.lead("ts").over(series).isNull(), "series_end").otherwise(F.lead("sr").over(series)))
    b = b.withColumn("dropped", F.lit(None).cast("string")).withColumn("run_first", F.lit(False))

    def excise(b: DataFrame, reason: str, flag, same, most: int) -> DataFrame:
        """Runs inside pieces of the bars not dropped so far."""
        live = F.col("dropped").isNull()
        alive = Window.partitionBy(*key, live).orderBy("ts")
        b = b.withColumn("piece", F.when(live, F.sum(F.when(F.col("sr").isNotNull(), 1).otherwise(0)).over(alive.rowsBetween(Window.unboundedPreceding, 0))))
        within = Window.partitionBy(*key, live, "piece").orderBy("ts")
        b = b.withColumn("new_run", F.coalesce(~same(within), F.lit(True)).cast("int"))
        b = b.withColumn("run", F.sum("new_run").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        length = F.count(F.lit(1)).over(Window.partitionBy(*key, live, "piece", "run"))
        b = b.withColumn("gone", live & flag & (length > most))
        b = b.withColumn("sr", F.when(live & F.coalesce(F.lag("gone").over(within), F.lit(False)), reason).otherwise(F.col("sr")))
        b = b.withColumn("er", F.when(live & F.coalesce(F.lead("gone").over(within), F.lit(False)), reason).otherwise(F.col("er")))
        b = b.withColumn("run_first", F.col("run_first") | (F.col("gone") & (F.col("new_run") == 1)))
        return b.withColumn("dropped", F.when(F.col("gone"), reason).otherwise(F.col("dropped"))).withColumnRenamed("piece", f"before_{reason}").drop("new_run", "run", "gone")

    idle = F.col("volume") <= t.epsilon
    b = excise(b, "illiquid", idle, lambda w: (F.lag(idle).over(w)) == idle, t.max_illiquid)
    b = excise(b, "stagnant", F.lit(True), lambda w: F.lag("close").over(w) == F.col("close"), max(t.max_stagnant, 1))
    live = F.col("dropped").isNull()
    alive = Window.partitionBy(*key, live).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("piece", F.when(live, F.sum(F.when(F.col("sr").isNotNull(), 1).otherwise(0)).over(alive)))
    n = F.count(F.lit(1)).over(Window.partitionBy(*key, live, "piece"))
    return b.withColumn("dropped", F.when(live & (n < t.min_bars), "min_length").otherwise(F.col("dropped")))


def segments(bars: DataFrame, key: list[str], t: Thresholds) -> DataFrame:
    """WIN9: (key, segment_id, start_ts, end_ts, n_bars, start_reason, end_reason)."""
    kept = clean_rows(bars, key, t).filter("dropped is null")
    out = kept.groupBy(*key, "piece").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n_bars"), F.min_by("sr", "ts").alias("start_reason"), F.max_by("er", "ts").alias("end_reason"))
    return out.withColumn("segment_id", F.concat_ws(":", *key, F.col("start_ts").cast("string"))).drop("piece")


def kept_bars(bars: DataFrame, key: list[str], t: Thresholds) -> DataFrame:
    """The bars that cleaning keeps, each with its segment_id: no index, no join."""
    kept = clean_rows(bars, key, t).filter("dropped is null")
    start = F.min("ts").over(Window.partitionBy(*key, "piece"))
    return kept.select(*bars.columns, F.concat_ws(":", *key, start.cast("string")).alias("segment_id"))


def segment_bars(bars: DataFrame, segs: DataFrame, key: list[str], before_ts: int | None = None) -> DataFrame:
    """JN4, FLT9: the bars of every segment of an index with its segment_id; a bar at the firewall is behind it.

    Segments of a series don't overlap, so starts and bars are merged in order of time: each bar looks back to the last
    start, and is in if that segment hasn't ended. Bars plus segments are sorted once; no bar meets a segment in a join.
    """
    rows = bars if before_ts is None else bars.filter(F.col("ts") < before_ts)
    columns = [c for c in rows.columns if c not in (*key, "ts")]
    segment = F.struct("segment_id", "end_ts")
    begun = segs.select(*key, F.col("start_ts").alias("ts"), F.lit(None).alias("__bar"), segment.alias("__segment"))
    both = rows.select(*key, "ts", F.struct(*columns).alias("__bar"), F.lit(None).alias("__segment")).unionByName(begun)
    upto = Window.partitionBy(*key).orderBy("ts", F.col("__bar").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("__segment", F.last("__segment", ignorenulls=True).over(upto))
    inside = placed.filter("__bar is not null and ts <= __segment.end_ts")
    return inside.select(*key, "ts", "__bar.*", "__segment.segment_id").select(*rows.columns, "segment_id")


def drop_stats(bars: DataFrame, key: list[str], t: Thresholds) -> DataFrame:
    """WIN10: per series and rule the bars dropped and runs excised, beside the series' total and kept bars."""
    rows = clean_rows(bars, key, t)
    total = bars.groupBy(*key).agg(F.count(F.lit(1)).alias("total_bars"))
    agg = [F.count(F.lit(1)).alias("in_session"), F.count_if(F.col("dropped").isNull()).alias("kept_bars")]
    agg += [F.count_if(F.col("cut") == r).alias(f"cut_{r}") for r in ("gap", "jump")]
    agg += [F.count_if(F.col("dropped") == r).alias(f"n_{r}") for r in ("illiquid", "stagnant", "min_length")]
    agg += [F.count_if((F.col("dropped") == r) & F.col("run_first")).alias(f"runs_{r}") for r in ("illiquid", "stagnant")]
    s = total.join(rows.groupBy(*key).agg(*agg), key, "left").fillna(0)
    zero = F.lit(0).cast("long")
    each = [("session_filter", F.col("total_bars") - F.col("in_session"), zero, zero), ("gap", zero, zero, F.col("cut_gap")), ("jump", zero, zero, F.col("cut_jump")), ("illiquid", F.col("n_illiquid"), F.col("runs_illiquid"), zero), ("stagnant", F.col("n_stagnant"), F.col("runs_stagnant"), zero), ("min_length", F.col("n_min_length"), zero, zero)]
    table = F.array(*(F.struct(F.lit(r).alias("rule"), a.alias("bars_dropped"), b.alias("runs_excised"), c.alias("cuts")) for r, a, b, c in each))
    return s.select(*key, "total_bars", "kept_bars", F.inline(table))


def segment_counts(bars: DataFrame, key: list[str], t: Thresholds) -> DataFrame:
    """WIN10: per series and rule the segments that it creates and drops, in one aggregate over the pieces that each bar has
    been in. An excision counts the net of what it splits and what it swallows whole."""
    pieces = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long")
    short = F.count_if((F.col("dropped") == "min_length") & F.col("sr").isNotNull())
    rows = clean_rows(bars, key, t).groupBy(*key).agg(*(F.count_if(F.col("cut") == r).alias(r) for r in ("gap", "jump")), pieces("before_illiquid").alias("a"), pieces("before_stagnant").alias("b"), pieces("piece").alias("c"), short.alias("short"))
    zero = F.lit(0).cast("long")
    net = {"session_filter": zero, "gap": F.col("gap"), "jump": F.col("jump"), "illiquid": F.col("b") - F.col("a"), "stagnant": F.col("c") - F.col("b"), "min_length": -F.col("short")}
    table = F.array(*(F.struct(F.lit(r).alias("rule"), F.greatest(n, zero).alias("segments_created"), F.greatest(-n, zero).alias("segments_dropped")) for r, n in net.items()))
    return rows.select(*key, F.inline(table))


def usable_windows(segs: DataFrame, by: list[str], context: int = CONTEXT, anchor: bool = True) -> DataFrame:
    """AGG13, AGG14: segments, bars, windows of `context` rows (one row less per segment with the anchor rule), longest."""
    return segs.groupBy(*by).agg(*_windows(context, anchor))


def _windows(context: int, anchor: bool) -> list:
    windows = F.greatest(F.col("n_bars") - (1 if anchor else 0) - (context - 1), F.lit(0))
    return [F.count(F.lit(1)).alias("segments"), F.sum("n_bars").alias("bars"), F.sum(windows).cast("long").alias("windows"), F.max("n_bars").alias("longest")]


def windows_by_grain(segs: DataFrame, grains: list[list[str]], symbol: str = "symbol", context: int = CONTEXT, anchor: bool = True) -> DataFrame:
    """AGG13 at several grains in one pass (grouping sets): the same counts and the distinct symbols of each group. `grain`
    is the place of the group's columns in `grains`; columns that a grain lacks are null."""
    columns = list(dict.fromkeys(c for g in grains for c in g))
    bit = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    named = F.create_map(*(F.lit(x) for i, g in enumerate(grains) for x in (sum(bit[c] for c in columns if c not in g), i)))
    out = segs.groupingSets([[F.col(c) for c in g] for g in grains], *columns).agg(F.grouping_id().alias("__id"), F.count_distinct(symbol).alias("symbols"), *_windows(context, anchor))
    return out.select(named[F.col("__id").cast("int")].alias("grain"), *columns, "symbols", "segments", "bars", "windows", "longest")


def drop_rates(stats: DataFrame, by: list[str]) -> DataFrame:
    """AGG15: share of the slice's bars that each rule drops; a series' total counts once."""
    total = stats.filter("rule = 'gap'").groupBy(*by).agg(F.sum("total_bars").alias("slice_bars"))
    dropped = stats.groupBy(*by, "rule").agg(F.sum("bars_dropped").alias("bars_dropped"))
    return dropped.join(total, by).withColumn("pct", F.bround(100 * F.col("bars_dropped") / F.col("slice_bars"), 4))


def most_cut(stats: DataFrame, key: list[str], limit: int = 20) -> DataFrame:
    """AGG16: the series that lose the largest share, a report of `limit` rows. by_rule: the bars that each rule drops,
    rules without any left out."""
    pairs = F.array_sort(F.collect_list(F.when(F.col("bars_dropped") > 0, F.struct("rule", "bars_dropped"))))  # six rules
    per = stats.groupBy(*key).agg(F.max("total_bars").alias("total_bars"), F.max("kept_bars").alias("kept_bars"), F.map_from_entries(pairs).alias("by_rule"))
    per = per.withColumn("dropped_bars", F.col("total_bars") - F.col("kept_bars")).withColumn("pct", F.bround(100 * F.col("dropped_bars") / F.col("total_bars"), 3))
    return per.orderBy(F.col("pct").desc(), F.col("dropped_bars").desc(), *key).limit(limit)


def canonical(rows: DataFrame, order: tuple[str, ...] = ("source", "asset_class", "market", "symbol", "frequency", "start_ts")) -> DataFrame:
    """TOP8: rows in the order that makes a rerun's files alike: sorted by range over all partitions, integers as integers.
    `order` should name a row uniquely."""
    return rows.orderBy(*(F.asc_nulls_first(c) for c in order))


def configs(segs: DataFrame) -> DataFrame:
    """AGG29: the configurations of an index with their segments; a sound index has one."""
    return segs.groupBy("clean_config_hash").agg(F.count(F.lit(1)).alias("segments"))


def overlaps(segs: DataFrame, key: list[str]) -> DataFrame:
    """AGG29: segments that begin before the one before them ends; a sound index has none."""
    w = Window.partitionBy(*key).orderBy("start_ts", "end_ts")
    return segs.withColumn("before_end", F.lag("end_ts").over(w)).filter("start_ts <= before_end")
