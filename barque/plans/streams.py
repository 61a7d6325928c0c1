"""Queries that run as streams over files of bars, to the rows of the batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barque.plans import queries as q
from barque.plans.catalog import query
from barque.plans.scratch import emptied, folder
from barque.streaming import live

BARS = "symbol string, ts long, open double, high double, low double, close double, volume double, amount double"
CUTS = (1_704_844_800_000, 1_705_708_800_000)  # 2024-01-10 and 2024-01-20


def _files(bars, at: str, part: int) -> None:
    """Append one file with a third of the bars of all series."""
    low, high = (-(1 << 62), *CUTS)[part], (*CUTS, 1 << 62)[part]
    bars.filter((F.col("ts") >= low) & (F.col("ts") < high)).coalesce(1).write.mode("append").parquet(at)


def _stream(spark, at: str):
    return spark.readStream.schema(BARS).option("maxFilesPerTrigger", 1).parquet(at)


@query(f"SELECT symbol, ts, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in ('gap', 'body', 'upper', 'lower', 'rel_volume', 'rel_amount'))} FROM ({q._features_sql(q.E_SQL)})")
def live_features_events(spark, d):
    """Bars as files; two batches, a restart from the checkpoint, and the third: the features of the batch query."""
    at = emptied(spark, folder(spark, "live_features_events"))
    bars = q.hourly(spark, d).select(*(x.split()[0] for x in BARS.split(", ")))
    for parts in ((0, 1), (2,)):
        for part in parts:
            _files(bars, f"{at}/bars", part)
        live.run_available(live.live_features(_stream(spark, f"{at}/bars")), at)
    out = spark.read.parquet(f"{at}/features")
    return out.select("symbol", "ts", *((F.round(c, 6) + 0.0).alias(c) for c in ("gap", "body", "upper", "lower", "rel_volume", "rel_amount")))


@query(f"""WITH bars AS (SELECT symbol, ts, open, high, low, close, CASE WHEN (ts // {q.H}) % 7 = 0 THEN -volume ELSE volume END AS volume FROM ({q.E_SQL}))
SELECT symbol, (ts // {q.D}) * {q.D} AS start, count(*) AS bars, count(*) FILTER (high < greatest(open, close)) AS high_below_open_or_close, count(*) FILTER (low > least(open, close)) AS low_above_open_or_close, count(*) FILTER (volume < 0) AS volume_negative
FROM bars GROUP BY 1, 2 HAVING (ts // {q.D}) * {q.D} + {q.D} <= (SELECT max(ts) FROM bars) - {q.H}""")
def live_counts_events(spark, d):
    """Rule breaks by series and day in three batches with a restart; the days that the watermark has passed. Every seventh
    hour's volume is made negative."""
    at = emptied(spark, folder(spark, "live_counts_events"))
    bars = q.hourly(spark, d).withColumn("volume", F.when(F.floor(F.col("ts") / q.H) % 7 == 0, -F.col("volume")).otherwise(F.col("volume")))
    bars = bars.select(*(x.split()[0] for x in BARS.split(", ")))
    for parts in ((0, 1), (2,)):
        for part in parts:
            _files(bars, f"{at}/bars", part)
        live.count_available(live.validation_counts(_stream(spark, f"{at}/bars")), at)
    return spark.read.parquet(f"{at}/counts")
