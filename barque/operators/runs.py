"""Runs over a corpus of series: sessions and calendars of artifacts, totals, sizes, work lists, manifests, publication
(FLT8, FLT7, FLT10, FLT11, FLT15, JN6, JN13, WIN1 by calendar, WIN23, WIN29, AGG9, AGG12, AGG27, AGG30, AGG31, AGG34,
AGG37, TOP6, SRC6, SRC8, SRC12, SRC13, SNK6, INC7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.functions.sessions import DAY, whole
from barque.operators.registry import content_hash

DERIVED = ("derived/", "clean/", "registry/", "staging/")
CLIP_RATE = 0.005


def refuse(why: str | Column) -> Column:
    return F.raise_error(F.lit(why) if isinstance(why, str) else why)


# ---- calendars and windows of time -----------------------------------------------------------------------------------


def calendar_of(days: DataFrame, by: list[str]) -> DataFrame:
    """Distinct session days (by, day number) with their ordinal from 1; one row a day, so a window over them is small."""
    return days.select(*by, "day").distinct().withColumn("ordinal", F.row_number().over(Window.partitionBy(*by).orderBy("day")))


def calendar_gaps(bars: DataFrame, calendar: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """WIN1, FLT7 for exchange calendars: daily bars beside `missing`, the sessions between a bar and the one before it,
    as a difference of ordinals, 0 for the first. A bar on a day that the calendar lacks is an error: bounds and holidays alike."""
    rows = bars.withColumn("day", whole(F.col("ts") / DAY)).join(calendar, [*by, "day"], "left")
    at = F.when(F.col("ordinal").isNull(), refuse("a bar outside the calendar").cast("int")).otherwise(F.col("ordinal"))
    w = Window.partitionBy(*key).orderBy("ts")
    return rows.withColumn("ordinal", at).withColumn("missing", F.greatest(F.col("ordinal") - F.lag("ordinal").over(w) - 1, F.lit(0))).drop("day")


def clipped(bars: DataFrame, low: int, high: int) -> DataFrame:
    """FLT8: low <= ts < high."""
    return bars.filter((F.col("ts") >= low) & (F.col("ts") < high))


def lookback(bars: DataFrame, now_ms: int, years: int) -> DataFrame:
    """FLT15: the last 365 * years days before now."""
    return bars.filter(F.col("ts") >= now_ms - 365 * years * DAY)


# ---- artifacts -------------------------------------------------------------------------------------------------------


def bar_artifacts(registry: DataFrame, sources: tuple[str, ...] = ("yahoo",), path: str = "artifact") -> DataFrame:
    """FLT10: artifacts of bars: not of event sources, not under a derived tier."""
    under = F.lit(False)
    for folder in DERIVED:
        under |= F.col(path).startswith(folder)
    return registry.filter(~F.col("source").isin(*sources) & ~under)


def with_session(artifacts: DataFrame, fallback: DataFrame, override: DataFrame) -> DataFrame:
    """FLT11: a session for each artifact: the override of its (source, asset_class), else its own, else the fallback of
    (source, asset_class); none is an error. Both tables have a row per pair at most."""
    by = ["source", "asset_class"]
    rows = artifacts.join(override.select(*by, F.col("session").alias("__over")), by, "left").join(fallback.select(*by, F.col("session").alias("__back")), by, "left")
    session = F.coalesce("__over", "session", "__back", refuse(F.concat(F.lit("no session for "), F.concat_ws("/", *by))))
    return rows.withColumn("session", session).drop("__over", "__back")


def with_literals(bars: DataFrame, sources: DataFrame) -> DataFrame:
    """SRC12: every bar beside the literals of its source (a row per source); an unknown source is an error."""
    rows = bars.join(sources.withColumn("__known", F.lit(True)), "source", "left")
    return rows.withColumn("source", F.when(F.col("__known"), F.col("source")).otherwise(refuse("unknown source"))).drop("__known")


def pinned(listing: DataFrame, symbol: str = "symbol") -> DataFrame:
    """SRC13: a pinned list with its rows per symbol; a symbol that stands twice is an error."""
    n = F.count(F.lit(1)).over(Window.partitionBy(symbol))
    return listing.withColumn(symbol, F.when(n == 1, F.col(symbol)).otherwise(refuse("a symbol stands twice")))


def pinned_as_recorded(listing: DataFrame, recorded: DataFrame, by: list[str]) -> DataFrame:
    """SRC13: the rows of lists whose content hash (registry.content_hash by list) is the recorded one; a list that has
    changed since, or was never recorded, is an error."""
    now = content_hash(listing, by).join(recorded.select(*by, F.col("content_hash").alias("then")), by, "left")
    same = F.coalesce(F.col("content_hash") == F.col("then"), F.lit(False))
    checked = now.select(*by, F.when(same, F.lit(True)).otherwise(refuse("a pinned list has changed").cast("boolean")).alias("ok"))
    return listing.join(checked, by).filter("ok").drop("ok")


def with_sizes(registry: DataFrame, files: DataFrame, path: str = "artifact") -> DataFrame:
    """JN13: bytes of each artifact by a listing (path, bytes); 0 where it lacks the file."""
    return registry.join(files.select(path, "bytes"), path, "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("long")))


def storage(registry: DataFrame) -> DataFrame:
    """AGG9: artifacts and bytes by source."""
    return registry.groupBy("source").agg(F.count(F.lit(1)).alias("artifacts"), F.sum("bytes").alias("bytes"))


def work_list(listing: DataFrame, frequencies: DataFrame, by: list[str], n: int, rank: str = "rank") -> DataFrame:
    """TOP6: the first n symbols of each market, once for every frequency (a handful of rows)."""
    return listing.filter(F.col(rank) <= n).select(*by, "symbol").join(F.broadcast(frequencies.select("frequency").distinct()))


def frames_to_bars(frames: DataFrame) -> DataFrame:
    """SRC6: nanosecond frames (ts, open, high, low, close, volume) to bars; trade columns are null, the amount is volume
    at the mean price."""
    mean = (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("n_trades", "long"), ("taker_buy_volume", "double"), ("taker_buy_quote_volume", "double"))]
    rest = [c for c in frames.columns if c not in ("ts", "open", "high", "low", "close", "volume")]
    return frames.select(*rest, whole(F.col("ts") / 1_000_000).alias("ts"), "open", "high", "low", "close", "volume", (F.col("volume") * mean).alias("amount"), *none)


def corporate_events(raw: DataFrame, key: list[str]) -> DataFrame:
    """SRC8: (key, ts, event_type, value) of splits and dividends; zero values go, another type is an error. A series that
    was captured and had no event has no row here: `captures` tells it from one that was not."""
    kind = F.when(F.col("event_type").isin("split", "dividend"), F.col("event_type")).otherwise(refuse("unknown event type"))
    return raw.withColumn("event_type", kind).filter("value <> 0").select(*key, "ts", "event_type", "value")


# ---- manifests -------------------------------------------------------------------------------------------------------


def identity_hash(manifests: DataFrame, volatile: list[str], name: str = "identity") -> DataFrame:
    """AGG34: SHA-256 of a manifest's fields as sorted JSON, but the volatile ones and nulls."""
    fields = sorted(c for c in manifests.columns if c not in volatile)
    return manifests.withColumn(name, F.sha2(F.to_json(F.struct(*fields)), 256))


def paired(manifests: DataFrame, a: str = "source_urls", b: str = "source_sha256s") -> DataFrame:
    """Manifests whose parallel lists don't pair up."""
    return manifests.filter(~F.coalesce(F.size(a) == F.size(b), F.lit(False)))


# ---- reports ---------------------------------------------------------------------------------------------------------


def clean_coverage(stats: DataFrame, by: list[str], artifact: str) -> DataFrame:
    """AGG12: series, bars and kept bars; an artifact, which has a row per rule, counts once."""
    one = stats.groupBy(*by, artifact).agg(F.max("total_bars").alias("total"), F.max("kept_bars").alias("kept"))
    return one.groupBy(*by).agg(F.count(F.lit(1)).alias("series"), F.sum("total").alias("bars"), F.sum("kept").alias("kept"))


def series_invariants(stats: DataFrame, segs: DataFrame, key: list[str], bars: DataFrame | None = None) -> DataFrame:
    """AGG30: series whose segments' bars aren't its kept bars, that keep more than they have, or whose segments are
    inverted, overlap or, with the bars at hand, run out of the series."""
    kept = stats.groupBy(*key).agg(F.max("total_bars").alias("total"), F.max("kept_bars").alias("kept"))
    before = F.lag("end_ts").over(Window.partitionBy(*key).orderBy("start_ts", "end_ts"))
    odd = (F.col("end_ts") < F.col("start_ts")) | F.coalesce(F.col("start_ts") <= before, F.lit(False))
    own = segs.withColumn("odd", odd).groupBy(*key).agg(F.sum("n_bars").alias("in_segments"), F.count_if("odd").alias("odd"), F.min("start_ts").alias("from"), F.max("end_ts").alias("to"))
    rows = kept.join(own, key, "left").fillna(0, ["in_segments", "odd"])
    bad = "in_segments <> kept or kept > total or odd > 0"
    if bars is not None:
        rows = rows.join(bars.groupBy(*key).agg(F.min("ts").alias("first"), F.max("ts").alias("last")), key, "left")
        bad += " or `from` < first or `to` > last"
    return rows.filter(bad)


def clip_flags(table: DataFrame, by: list[str], most: float = CLIP_RATE) -> DataFrame:
    """AGG27: rows of a clip table (n, clipped) whose clip rate is over `most`."""
    return table.select(*by, (F.col("clipped") / F.col("n")).alias("clip_rate")).filter(F.col("clip_rate") > most)


def run_totals(outcomes: DataFrame) -> DataFrame:
    """AGG37: one row over outcomes (status ok, failed or reused; segments, total_bars, kept_bars)."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    total, kept = F.coalesce(F.sum("total_bars"), F.lit(0)), F.coalesce(F.sum("kept_bars"), F.lit(0))
    return outcomes.agg(n("ok"), n("failed"), n("reused"), F.coalesce(F.sum("segments"), F.lit(0)).alias("segments"), total.alias("total_bars"), kept.alias("kept_bars"), (total - kept).alias("dropped_bars"), F.try_divide(kept, total).alias("coverage"))


def captures(manifests: DataFrame, key: list[str], source: str = "yahoo", kind: str = "events") -> DataFrame:
    """Series whose events were captured: those with an artifact of events in the manifests, whatever it holds."""
    return manifests.filter((F.col("source") == source) & (F.col("kind") == kind)).select(*key).distinct()


def with_events(registry: DataFrame, events: DataFrame, captured: DataFrame, key: list[str]) -> DataFrame:
    """JN6: series beside the number of their events: null where none were captured, 0 where a capture holds none. Events
    are counted before they meet."""
    counts = events.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    known = captured.select(*key).distinct().join(counts, key, "left").select(*key, F.coalesce("n", F.lit(0).cast("long")).alias("n_events"))
    return registry.join(known, key, "left")


def tr_available(verdict: Column, captured: Column) -> Column:
    """WIN29: total returns need no events under identity verdicts, captured ones under `accumulate`, else an error."""
    return F.when(verdict.isin("split+dividend", "not_applicable"), True).when(verdict == "accumulate", captured).otherwise(refuse("unknown verdict").cast("boolean"))


def tr_coverage(series: DataFrame, by: list[str]) -> DataFrame:
    """AGG31: tickers, those with total returns, their share in percent, those with a capture, those that it fails (events
    needed, none captured), and those captured without an event. series: verdict, n_events."""
    has = F.col("n_events").isNotNull()
    can = tr_available(F.col("verdict"), has)
    ok = F.count_if(can)
    return series.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tickers"), ok.alias("available"), F.bround(100 * ok / F.count(F.lit(1)), 3).alias("pct"), F.count_if(has).alias("with_events"),
        F.count_if(~can).alias("failed"), F.count_if(F.col("n_events") == 0).alias("without_an_event"),
    )


def inverse_table(anchors: DataFrame, prices: DataFrame, flows: DataFrame, key: list[str]) -> DataFrame:
    """WIN23: the anchor bar as it is and every bar after it from both inverses; trade columns are null."""
    columns = [*key, "ts", "open", "high", "low", "close", "volume", "amount"]
    rows = prices.join(flows, [*key, "ts"]).select(*columns).unionByName(anchors.select(*columns))
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in (("n_trades", "long"), ("taker_buy_volume", "double"), ("taker_buy_quote_volume", "double"))})


# ---- outputs ---------------------------------------------------------------------------------------------------------


def constants_output(constants: DataFrame, by: list[str], features: list[str]) -> DataFrame:
    """SNK6: center and scale to 12 significant digits; a slice without every feature is an error."""
    n = F.size(F.array_intersect(F.collect_set("feature").over(Window.partitionBy(*by)), F.array(*map(F.lit, features))))
    digits = lambda c: F.format_string("%.11e", F.col(c)).cast("double")
    rows = constants.withColumn("feature", F.when(n == len(features), F.col("feature")).otherwise(refuse("a slice lacks a feature")))
    return rows.withColumns({"center": digits("center"), "scale": digits("scale")})


def isolated(rows: DataFrame, good: Column, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """INC7: what may be worked on, and a row per failed `by` with its number of bad rows; one bad row fails its file."""
    ok = F.coalesce(good, F.lit(False))
    failures = rows.filter(~ok).groupBy(*by).agg(F.count(F.lit(1)).alias("bad_rows"))
    return rows.join(failures.select(*by), by, "left_anti"), failures
