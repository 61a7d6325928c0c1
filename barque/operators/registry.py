"""Registry reports, universes and incremental sets over manifest-like rows (AGG7, AGG8, AGG10, AGG11, AGG33, TOP1 to TOP5, JN7 to JN9, FLT12, FLT13, INC1, INC3, INC5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.functions.sessions import DAY


def registry_rows(stats: DataFrame) -> DataFrame:
    """AGG7: statistics of series with their history in days; what identifies a series and its file comes along as columns
    of `stats`."""
    return stats.withColumn("history_days", F.bround((F.col("last_ts") - F.col("first_ts")) / DAY, 3))


def coverage(registry: DataFrame, by: list[str]) -> DataFrame:
    """AGG8: series, bars and span; bytes where the registry has them (JN13)."""
    size = [F.sum("bytes").alias("bytes")] if "bytes" in registry.columns else []
    return registry.groupBy(*by).agg(F.count(F.lit(1)).alias("series"), F.sum("row_count").alias("bars"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), *size)


def group_stats(registry: DataFrame, by: list[str]) -> DataFrame:
    """AGG11; the total of bars off the grid where the registry has them."""
    off = [F.sum("off_grid").alias("off_grid")] if "off_grid" in registry.columns else []
    return registry.groupBy(*by).agg(
        F.count(F.lit(1)).alias("series"), F.sum("row_count").alias("n_rows"), F.round(F.min("history_days"), 1).alias("min_days"), F.round(F.percentile("history_days", 0.5), 1).alias("median_days"),
        F.round(F.max("history_days"), 1).alias("max_days"), F.sum("gap_count").alias("gaps"), F.percentile("gap_count", 0.5).alias("median_gaps"), F.count_if(F.col("gap_count") == 0).alias("without_gaps"), *off,
    )


def gappiest(registry: DataFrame, key: list[str], limit: int = 15) -> DataFrame:
    """TOP1, a report of `limit` rows."""
    return registry.filter("gap_count > 0").select(*key, "gap_count").orderBy(F.col("gap_count").desc(), *key).limit(limit)


def stalest(registry: DataFrame, key: list[str], now_ms: int, limit: int = 15) -> DataFrame:
    """TOP2, a report of `limit` rows."""
    days = F.round((F.lit(now_ms) - F.col("last_ts")) / DAY, 1)
    return registry.select(*key, days.alias("days")).orderBy(F.col("days").desc(), *key).limit(limit)


def required_coverage(registry: DataFrame, required: DataFrame, by: list[str], freq: str = "frequency") -> DataFrame:
    """AGG10: required (by, frequency) rows against the registry, with the missing ones listed."""
    have = registry.groupBy(*by, freq).agg(F.count(F.lit(1)).alias("n"))
    rows = required.join(have, [*by, freq], "left")
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.when(F.col("n").isNull(), F.col(freq)))).alias("missing"), F.coalesce(F.sum("n"), F.lit(0)).alias("series")).withColumn("ok", F.size("missing") == 0)


def universe(registry: DataFrame, by: list[str], measure: str, n: int, symbol: str = "symbol") -> DataFrame:
    """TOP3, TOP4: the n of each market by a positive measure, then by symbol."""
    w = Window.partitionBy(*by).orderBy(F.col(measure).desc(), symbol)
    return registry.filter(F.col(measure) > 0).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select(*by, symbol, measure, "rank")


def with_history(registry: DataFrame, years: float) -> DataFrame:
    """FLT13: series with so many years of history at least, by first and last bar."""
    return registry.filter(F.col("history_days") >= years * 365.25)


def listed_before(listing: DataFrame, now_month: str, years: int, first: str = "first_month") -> DataFrame:
    """FLT13 before anything is downloaded: by the first month (yyyy-MM) that a listing names, that month `years` years before
    now's or earlier; series without one stay out."""
    year, month = map(int, now_month.split("-"))
    return listing.filter(F.col(first) <= f"{year - years:04d}-{month:02d}")


def top_counts(rows: DataFrame, column: str, limit: int) -> DataFrame:
    """TOP5: the most common values, equal counts by the value as a string; a report of `limit` rows."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column).cast("string")).limit(limit)


def candidates(listing: DataFrame, quote: str, excluded: list[str]) -> DataFrame:
    """FLT12: symbols of one quote whose base is no excluded currency and no leveraged version of a base in the whole
    listing, excluded ones too."""
    listed = listing.filter(F.col("symbol").endswith(quote)).withColumn("base", F.expr(f"left(symbol, length(symbol) - {len(quote)})"))
    rows = listed.filter((F.col("base") != "") & ~F.col("base").isin(excluded))
    plain = F.regexp_replace("base", "(UP|DOWN|BULL|BEAR)$", "")
    tagged = rows.withColumn("plain", F.when((plain != F.col("base")) & (F.length(plain) >= 2), plain))
    return tagged.join(listed.select(F.col("base").alias("plain")), "plain", "left_anti").select("symbol", "base")


def in_both(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """JN9."""
    return a.select(*columns).intersect(b.select(*columns))


def stale(registry: DataFrame, index: DataFrame) -> DataFrame:
    """JN7: artifacts that the index lacks in this version. index: artifact, sha256 of segments or drop statistics, so
    that a series that cleans to nothing isn't stale for ever."""
    return registry.join(index.select("artifact", "sha256"), ["artifact", "sha256"], "left_anti")


def carried(old: DataFrame, fresh: DataFrame, new: DataFrame) -> DataFrame:
    """JN8: old rows of artifacts that are still fresh, and the new rows. Give old through `of_config`."""
    return old.join(fresh.select("artifact"), "artifact", "left_semi").unionByName(new)


def of_config(index: DataFrame, config_hash: str) -> DataFrame:
    """INC3: the index, refused with an error when it is read if any of its rows has another configuration."""
    same = F.col("clean_config_hash").eqNullSafe(F.lit(config_hash))
    return index.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("segments of another configuration: run in full")).cast("boolean")))


def content_hash(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG33: SHA-256 over the rows as a multiset, whatever their order and partitions: sums of the four quarters of the
    rows' own digests and their number, which Spark adds up before it shuffles; no task holds the rows."""
    row = F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in (by or []))), {"ignoreNullFields": "false"}), 256)
    quarters = [F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(x).alias(f"q{i}") for i, x in enumerate(quarters)]
    out = df.select(*(by or []), row.alias("h")).groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *sums)
    parts = [F.col("n").cast("string"), *(F.pmod(F.coalesce(f"q{i}", F.lit(0)), F.lit(str(1 << 64)).cast("decimal(30,0)")).cast("string") for i in range(4))]
    return out.select(*(by or []), F.sha2(F.concat_ws(":", *parts), 256).alias("content_hash"))


def verdicts(manifests: DataFrame) -> DataFrame:
    """INC5: one stamped verdict is used, none falls back to the recorded policy, several are an error."""
    found = F.collect_set("adjustment_policy_verified")
    out = manifests.groupBy("source").agg(found.alias("found"), F.min("adjustment_policy").alias("recorded"))
    return out.select("source", F.when(F.size("found") > 1, F.raise_error(F.lit("several verdicts"))).when(F.size("found") == 1, F.get("found", F.lit(0))).otherwise(F.col("recorded")).alias("verdict"))


def current(plan: DataFrame, manifests: DataFrame) -> DataFrame:
    """INC1: artifacts whose recorded digests equal the expected ones, in order."""
    return plan.join(manifests.select("artifact", F.col("source_sha256s").alias("have")), "artifact").filter("source_sha256s = have").select("artifact")


def query(registry: DataFrame, sql: str, limit: int = 50) -> DataFrame:
    """SRC10: SQL in which {registry} stands for the table; a report of `limit` rows. The view lasts no longer than the call."""
    return registry.sparkSession.sql(sql, registry=registry).limit(limit)
