"""Audits: prefix consistency, sampling, probes (WIN11, WIN24, WIN25)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.functions.sessions import DAY, expected_open, missing_slots, open_prefix, whole
from barque.operators.features import raw_features


def prefix_audit(bars: DataFrame, key: list[str], splits: DataFrame, made: Callable[[DataFrame, list[str]], DataFrame] = raw_features) -> DataFrame:
    """WIN24: features (made of bars and key) of the bars up to a split equal the first features of all bars, bit for bit.
    splits: key, split_row. Returns (key, split_row, n_rows, differing)."""
    numbered = bars.withColumn("i", F.row_number().over(Window.partitionBy(*key).orderBy("ts")))
    cut = numbered.join(splits, key).filter("i <= split_row").drop("i")
    full, part = made(bars, key), made(cut, [*key, "split_row"])
    names = [c for c in full.columns if c not in (*key, "ts")]
    same = F.struct(*(part[c] for c in names)).eqNullSafe(F.struct(*(full[c] for c in names)))
    on = [part[k] == full[k] for k in (*key, "ts")]
    joined = part.join(full, on, "left").select(*(part[k] for k in key), part["split_row"], same.alias("same"))
    return joined.groupBy(*key, "split_row").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("same")).alias("differing"))


def sample(segments: DataFrame, n: int, least_bars: int, seed: int) -> DataFrame:
    """WIN25: a deterministic choice of n segments."""
    return seeded_sample(segments.filter(F.col("n_bars") >= least_bars), ["segment_id"], n, seed)


def seeded_sample(rows: DataFrame, names: list[str], n: int, seed: int) -> DataFrame:
    """TOP7: n rows that depend on their names and the seed alone, whatever the order and the partitions; a report of n rows."""
    return rows.orderBy(F.xxhash64(*names, F.lit(seed)), *names).limit(n)


def probe_gaps(bars: DataFrame, key: list[str], step_ms: int) -> DataFrame:
    """WIN11: how many gaps of each size a strict series has."""
    w = Window.partitionBy(*key).orderBy("ts")
    gap = ((F.col("ts") - F.lag("ts").over(w)) / step_ms).cast("long") - 1
    return bars.withColumn("gap", gap).filter("gap > 0").groupBy(*key, "gap").agg(F.count(F.lit(1)).alias("n"))


WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def probe(bars: DataFrame, key: list[str], kind: str, step_ms: int, break_hours: tuple[int, int] = (-1, -1), top: int = 8) -> DataFrame:
    """WIN11: why a series fell apart, one row for each: bars, first_ts, last_ts, expected_open_slots, unexpected_gaps,
    missing_open_slots, gap_sizes, missing_by_hour, missing_by_weekday (the `top` entries each, by falling count, then by
    the entry as a string), zero_volume_bars and zero_volume_in_shut.

    No slot is enumerated. A gap misses the slots in [a, b); of those with hour of the week w there are f(b, w) - f(a, w),
    where f(j, w) is j's whole weeks, and one more if j stands past w in its week. So all gaps of a series are summed up as
    the number of their edges at each hour of the week and their whole weeks.
    """
    n, unit = (7 if step_ms >= DAY else 168), min(step_ms, DAY)
    prefix = open_prefix(kind, step_ms, break_hours)
    is_open = [b - a for a, b in zip(prefix[:-1], prefix[1:], strict=True)]
    series = Window.partitionBy(*key).orderBy("ts")
    first = F.first("ts").over(series.rowsBetween(Window.unboundedPreceding, 0))
    rows = bars.select(*key, "ts", "volume", first.alias("first"), F.lag("ts").over(series).alias("before"))
    slot = lambda c: whole((F.col(c) - F.col("first")) / step_ms)
    missing = missing_slots(F.col("ts"), F.col("before"), F.col("first"), kind, step_ms, break_hours)
    rows = rows.select("*", missing.alias("missing"), (whole(F.col("first") / unit) + slot("before") + 1).alias("a"), (whole(F.col("first") / unit) + slot("ts")).alias("b"))

    table = F.array(*map(F.lit, prefix))
    upto = lambda j: whole(j / n) * prefix[-1] + F.get(table, F.pmod(j, F.lit(n)).cast("int"))
    start = whole(F.min("ts") / unit)
    end = start + whole((F.max("ts") - F.min("ts")) / step_ms) + 1
    idle = F.col("volume") <= 0
    out = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("bars"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), (upto(end) - upto(start)).alias("expected_open_slots"),
        F.count_if(F.col("missing") > 0).alias("unexpected_gaps"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_open_slots"),
        F.count_if(idle).alias("zero_volume_bars"), F.count_if(idle & ~expected_open(F.col("ts"), kind, step_ms, break_hours)).alias("zero_volume_in_shut"),
    )

    # one row for each size of gap, and for each hour of the week at which gaps begin or end
    item = lambda what, at, sign, weeks: F.struct(F.lit(what).alias("what"), at.alias("at"), F.lit(sign).cast("long").alias("sign"), weeks.alias("weeks"))
    edge = lambda c, sign: item("edge", F.pmod(F.col(c), F.lit(n)).cast("long"), sign, sign * whole(F.col(c) / n))
    items = rows.filter("missing > 0").select(*key, F.inline(F.array(item("size", F.col("missing"), 1, F.lit(0).cast("long")), edge("b", 1), edge("a", -1))))
    items = items.groupBy(*key, "what", "at").agg(F.sum("sign").alias("n"), F.sum("weeks").alias("weeks"))
    edges = items.filter("what = 'edge'").groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("net"), F.sum("weeks").alias("weeks"))  # a week's hours
    past = lambda w: F.aggregate(F.sequence(F.lit(w + 1).cast("long"), F.lit(n).cast("long")), F.lit(0).cast("long"), lambda s, r: s + F.coalesce(F.col("net")[r], F.lit(0)))
    when = lambda w: (F.lit(str(0 if n == 7 else w % 24)), F.lit(WEEKDAYS[(w + 3) % 7 if n == 7 else (w // 24 + 3) % 7]))
    each = F.array(*(F.struct(when(w)[0].alias("hour"), when(w)[1].alias("weekday"), (F.col("weeks") + past(w)).alias("n")) for w in range(n) if is_open[w]))
    slots = edges.select(*key, F.inline(each)).filter("n > 0")
    by = lambda what, c: slots.groupBy(*key, F.lit(what).alias("what"), F.col(c).alias("entry")).agg(F.sum("n").alias("n"))
    sizes = items.filter("what = 'size'").select(*key, "what", F.col("at").cast("string").alias("entry"), "n")
    counts = sizes.unionByName(by("hour", "hour")).unionByName(by("weekday", "weekday"))
    order = Window.partitionBy(*key, "what").orderBy(F.desc("n"), "entry")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    entries = lambda what: F.transform(F.array_sort(F.collect_list(F.when(F.col("what") == what, F.struct("rank", "entry", "n")))), lambda x: F.struct(x["entry"].alias("entry"), x["n"].alias("n")))
    best = best.groupBy(*key).agg(entries("size").alias("gap_sizes"), entries("hour").alias("missing_by_hour"), entries("weekday").alias("missing_by_weekday"))
    return out.join(best, key, "left")
