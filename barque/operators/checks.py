"""Guards, red flags and verdicts over the reports of other operators (FLT14, AGG17, AGG20, AGG28, AGG32, AGG38, AGG39, WIN26, SNK5, INC6).

The verdicts are columns; a refusal is an error of the job only where its rule says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.operators.adjust import total_return
from barque.operators.registry import content_hash

#: Fixed values.
MAJORS = ("AAPL", "BTCUSDT", "ETHUSDT", "EURUSD", "SPY", "USDJPY", "XAUUSD")
MAJOR_PCT, SLICE_PCT, SPLITS_A_SERIES = 1.0, 15.0, 300.0
DIVIDEND_AGREEMENT, UNRANKED, UNREADABLE = 0.02, 0.01, 0.001
GEO, RET = ("gap", "body", "upper", "lower"), ("ret_open", "ret_high", "ret_low", "ret_close")


def with_rules(rows: DataFrame, rules: DataFrame, by: list[str]) -> DataFrame:
    """FLT14: rows beside their thresholds (rules: by, verified, ...). No rule, or one not verified, is an error."""
    joined = rows.join(rules.withColumn("known", F.lit(True)), by, "left")
    bad = ~(F.coalesce("known", F.lit(False)) & F.coalesce("verified", F.lit(False)))
    why = F.concat(F.lit("no verified thresholds for "), F.concat_ws("/", *by))
    return joined.withColumn("verified", F.when(bad, F.raise_error(why).cast("boolean")).otherwise(F.lit(True))).drop("known")


def unruled(rows: DataFrame, rules: DataFrame, by: list[str]) -> DataFrame:
    """FLT14 as a report: the keys that `with_rules` refuses, and their rows."""
    return rows.join(rules.filter("verified").select(*by), by, "left_anti").groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def red_flags(stats: DataFrame, key: list[str], by: list[str], majors: tuple[str, ...] = MAJORS, symbol: str = "symbol", major_pct: float = MAJOR_PCT, splits: float = SPLITS_A_SERIES, slice_pct: float = SLICE_PCT) -> DataFrame:
    """AGG17: (check, subject, value, limit) over drop statistics (a row per series and rule).

    A major that loses over major_pct of its in-session bars; slices cut at gaps over `splits` times a series; slices
    that lose over slice_pct of their bars. by is a part of key.
    """
    name = lambda columns: F.concat_ws("/", *columns)
    dropped = lambda session: F.sum(F.when((F.col("rule") == "session_filter") == session, F.col("bars_dropped")).otherwise(0))
    series = stats.groupBy(*key).agg(F.max("total_bars").alias("total"), dropped(True).alias("closed"), dropped(False).alias("lost"), F.sum(F.when(F.col("rule") == "gap", F.col("cuts")).otherwise(0)).alias("cuts"))
    traded = F.col("total") - F.col("closed")
    of_major = F.when(traded > 0, F.bround(100 * F.col("lost") / traded, 3)).otherwise(0.0)
    flags = [series.filter(F.col(symbol).isin(*majors)).select(F.lit("major_series_loss").alias("check"), name(key).alias("subject"), of_major.alias("value"), F.lit(float(major_pct)).alias("limit"))]
    slices = series.groupBy(*by).agg((F.sum("cuts") / F.count(F.lit(1))).alias("splits"), F.try_divide(100 * F.sum(F.col("lost") + F.col("closed")), F.sum("total")).alias("pct"))
    flags.append(slices.select(F.lit("weekend_cut_as_gap").alias("check"), name(by).alias("subject"), F.col("splits").alias("value"), F.lit(float(splits)).alias("limit")))
    flags.append(slices.select(F.lit("slice_loss").alias("check"), name(by).alias("subject"), F.col("pct").alias("value"), F.lit(float(slice_pct)).alias("limit")))
    rows = flags[0].unionByName(flags[1]).unionByName(flags[2]).filter("value > limit")
    return rows.withColumn("value", F.when(F.col("check") == "weekend_cut_as_gap", F.bround("value", 1)).otherwise(F.bround("value", 3)))


def adjustment_class(probes: DataFrame, comparisons: DataFrame, by: list[str]) -> DataFrame:
    """AGG20: what a source's closes are adjusted for. probes: by, verdict; comparisons: by, status, median_diff.

    Any unadjusted probe decides; without decided probes the class is unknown; dividends count only where the upper
    median of the series' median differences is at most DIVIDEND_AGREEMENT.
    """
    p = probes.groupBy(*by).agg(F.count_if(F.col("verdict").isin("adjusted", "unadjusted")).alias("decided"), F.count_if(F.col("verdict") == "unadjusted").alias("cliffs"))
    w = Window.partitionBy(*by).orderBy("median_diff")
    c = comparisons.filter("status = 'compared'").select(*by, "median_diff", F.row_number().over(w).alias("i"), F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("compared"))
    c = c.filter("i = compared div 2 + 1").select(*by, "compared", F.col("median_diff").alias("agreement"))
    cls = F.when(F.col("decided") == 0, "unknown").when(F.col("cliffs") > 0, "unadjusted").when(F.col("agreement") <= DIVIDEND_AGREEMENT, "split+dividend").otherwise("split")
    return p.join(c, by, "left").select(*by, "decided", F.coalesce("compared", F.lit(0)).alias("compared"), "agreement", cls.alias("policy"))


def spec_comparison(table: DataFrame, by: list[str]) -> DataFrame:
    """AGG28: table (by, feature, n, clipped, q01, q99) to pooled clip rate in percent and mean spread of each spec's four
    price features; slices that lack a spec are left out."""
    out = table.groupBy(*by)
    cols = []
    for spec, names in (("geo", GEO), ("ret", RET)):
        own = F.col("feature").isin(*names)
        n = F.sum(F.when(own, F.col("n")))
        cols += [F.round(100 * F.sum(F.when(own, F.col("clipped"))) / F.greatest(n, F.lit(1)), 3).alias(f"{spec}_clip_pct"), F.round(F.avg(F.when(own, F.col("q99") - F.col("q01"))), 4).alias(f"{spec}_span")]
    return out.agg(*cols).filter("geo_span is not null and ret_span is not null")


def ranking_summary(registry: DataFrame, by: list[str], measure: str, most: float = UNRANKED) -> DataFrame:
    """AGG32: ranked, zero and unmeasured candidates; refused where over `most` of them have no measure."""
    m = F.col(measure)
    none = m.isNull() | F.isnan(m)
    out = registry.groupBy(*by).agg(F.count_if(~none & (m > 0)).alias("ranked"), F.count_if(~none & (m <= 0)).alias("zero_volume"), F.count_if(none).alias("unrankable"))
    return out.withColumn("refused", F.col("unrankable") > most * (F.col("ranked") + F.col("zero_volume") + F.col("unrankable")))


def failure_rates(runs: DataFrame, by: list[str], kind: str = "failure_kind", most: float = UNREADABLE) -> DataFrame:
    """AGG38: files tried, unreadable, and rejected on an invariant; only the unreadable fail a run, over `most`."""
    out = runs.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col(kind) == "unreadable").alias("unreadable"), F.count_if(F.col(kind) == "rejected").alias("rejected"))
    return out.withColumn("fails", F.col("unreadable") > most * F.col("files"))


def contract_qa(long: DataFrame, audits: DataFrame, refusals: DataFrame, by: list[str]) -> DataFrame:
    """AGG39: rows and NaN of features (by, x), audits run and passed (by, differing), refusals (by, code); fatal if any
    value is NaN or null, any audit differs or any segment is refused. The three are counted before they meet."""
    zero = lambda *names: [F.lit(0).cast("long").alias(n) for n in names]
    names = ["n_rows", "nans", "audits", "passed", "failures"]
    a = long.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.isnan("x") | F.col("x").isNull()).alias("nans")).select(*by, "n_rows", "nans", *zero(*names[2:]))
    b = audits.groupBy(*by).agg(F.count(F.lit(1)).alias("audits"), F.count_if(F.col("differing") == 0).alias("passed")).select(*by, *zero(*names[:2]), "audits", "passed", *zero("failures"))
    c = refusals.groupBy(*by).agg(F.count(F.lit(1)).alias("failures")).select(*by, *zero(*names[:4]), "failures")
    out = a.unionByName(b).unionByName(c).groupBy(*by).agg(*(F.sum(n).alias(n) for n in names))
    return out.withColumn("fatal", (F.col("nans") > 0) | (F.col("passed") < F.col("audits")) | (F.col("failures") > 0))


def pinned_snapshots(segments: DataFrame, features: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """WIN26: a digest of each series' longest segment (ties: the larger segment_id) as float32 values. segments: key,
    segment_id, start_ts, end_ts, n_bars; features: key, ts and values."""
    longest = segments.groupBy(*key).agg(F.max_by(F.struct("segment_id", "start_ts", "end_ts"), F.struct("n_bars", "segment_id")).alias("s")).select(*key, "s.*")
    rows = features.join(longest, key).filter("ts between start_ts and end_ts").select(*key, "segment_id", "ts", *(F.col(v).cast("float").alias(v) for v in values))
    count = rows.groupBy(*key, "segment_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return count.join(content_hash(rows, [*key, "segment_id"]), [*key, "segment_id"])


def total_return_tier(bars: DataFrame, dividends: DataFrame, verdicts: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """SNK5: total-return closes of series whose verdict is `accumulate`; and for every series whether it was derived,
    with its bars and dividends. verdicts: key, verdict."""
    ok = verdicts.filter("verdict = 'accumulate'").select(*key)
    tier = total_return(bars.join(ok, key, "left_semi"), dividends.join(ok, key, "left_semi"), key).drop("close")
    counts = bars.groupBy(*key).agg(F.count(F.lit(1)).alias("bars")).join(dividends.groupBy(*key).agg(F.count(F.lit(1)).alias("dividends")), key, "left")
    derived = F.coalesce(F.col("verdict") == "accumulate", F.lit(False))
    return tier, counts.join(verdicts, key, "left").select(*key, "bars", F.coalesce("dividends", F.lit(0)).alias("dividends"), derived.alias("derived"))


def reproduced(recorded: DataFrame, rebuilt: DataFrame, key: list[str]) -> DataFrame:
    """INC6: recorded (key, source_hash, content_hash) against rebuilt (the same, null where the rebuild failed):
    identical; drifted if the source itself changed; mismatch if only the result did; failed."""
    r = rebuilt.select(*key, F.col("source_hash").alias("new_source"), F.col("content_hash").alias("new_content"))
    status = F.when(F.col("new_content").isNull(), "failed").when(F.col("content_hash") == F.col("new_content"), "identical").when(F.col("source_hash").eqNullSafe(F.col("new_source")), "mismatch").otherwise("drifted")
    return recorded.join(r, key, "left").select(*key, status.alias("status"))
