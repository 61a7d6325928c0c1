"""Choice of the files and chunks to read (SRC5, SRC11, INC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LINES = 30


def member_class(members: DataFrame, path: str = "path", lines: str = "n_lines", least: int = LEAST_LINES) -> DataFrame:
    """SRC5: members of an archive (path, n_lines) with `status`: `keep` for US stock and fund texts, else the reason."""
    p = F.lower(F.concat(F.lit("/"), F.coalesce(path, F.lit(""))))
    other = p.rlike("/[^/]*(indices|futures|currencies|bonds|commodities)[^/]*/")
    status = F.when(~p.endswith(".txt"), "not_text").when(~p.contains("/us/"), "not_us").when(other | ~p.rlike("/[^/]*(stocks|etfs)[^/]*/"), "not_equity").when(F.coalesce(lines, F.lit(0)) < least, "too_short").otherwise("keep")
    return members.withColumn("status", status)


def archive_selection(listing: DataFrame, by: list[str]) -> DataFrame:
    """SRC11: listing (by, kind monthly or daily, period) to all months, then the days after the last month; `position`
    is their order."""
    last = listing.filter("kind = 'monthly'").groupBy(*by).agg(F.max("period").alias("last_month"))
    rows = listing.join(last, by, "left")
    wanted = (F.col("kind") == "monthly") | F.col("last_month").isNull() | (F.substring("period", 1, 7) > F.col("last_month"))
    order = F.struct((F.col("kind") == "daily").alias("late"), "period")
    listed = rows.filter(wanted).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "kind", "period"))).alias("x"))
    return listed.select(*by, F.posexplode("x").alias("position", "y")).select(*by, "y.kind", "y.period", "position")


def year_chunks(series: DataFrame, key: list[str], prefix: str, start: str, as_of: str) -> DataFrame:
    """INC2: a row per series and year from the column `start` to the date as_of: token, sealed, and the digest that
    tells whether it must be read again (a sealed year's never changes, the current year's changes daily)."""
    day = F.lit(as_of).cast("date")
    rows = series.select(*key, F.explode(F.when(F.col(start) <= F.year(day), F.sequence(F.col(start).cast("int"), F.year(day)))).alias("year"))
    token = F.concat(F.lit(f"{prefix}://"), F.concat_ws("/", *key, "year"))
    rows = rows.withColumn("token", token).withColumn("sealed", F.col("year") < F.year(day))
    return rows.withColumn("digest", F.sha2(F.when(F.col("sealed"), F.col("token")).otherwise(F.concat("token", F.lit(f"#{as_of}"))), 256))


def as_of_digests(series: DataFrame, symbol: str, as_of: str) -> DataFrame:
    """INC2b: one digest per series and day, so that a second run on a day reads nothing."""
    return series.withColumn("digest", F.sha2(F.concat(F.col(symbol), F.lit(f"#{as_of}")), 256))
