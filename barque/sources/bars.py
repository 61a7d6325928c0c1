"""Bars: schema, readers of the text formats, resampling from ticks, writer.

A series is (source, market, symbol, frequency); these are columns, and the key of every window. Times are the bar's
opening in epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barque.functions.sessions import DAY, epoch_millis, millis, whole

SERIES = ["source", "market", "symbol", "frequency"]
STEPS = {"1h": 3_600_000, "1d": DAY}
FIELDS = "ts long, open double, high double, low double, close double, volume double, amount double, n_trades long, taker_buy_volume double, taker_buy_quote_volume double"
BARS = "source string, market string, asset_class string, symbol string, frequency string, session_id string, " + FIELDS
KLINE = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "n_trades", "taker_buy_volume", "taker_buy_quote_volume", "ignore"]
MALFORMED = 0.001


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    """SRC1: the Parquet tier; filters on the partition columns prune folders."""
    return spark.read.schema(BARS).parquet(root)


def bars_from_ticks(ticks: DataFrame, symbol: str, ts: str, price: str, size: str, order: str, step_ms: int) -> DataFrame:
    """Bars (symbol, ts, open, high, low, close, volume, amount) of ticks, whose times count to the nearest
    millisecond; ticks of one time are in `order`'s order."""
    at = epoch_millis(ts)
    key, p, n = F.struct(F.col(ts), F.expr(order)), F.expr(price), F.expr(size).cast("double")
    rows = ticks.select(F.col(symbol).cast("string").alias("symbol"), (whole(at / step_ms) * step_ms).alias("bar"), key.alias("k"), p.alias("p"), n.alias("n"))
    return rows.groupBy("symbol", F.col("bar").alias("ts")).agg(F.min_by("p", "k").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "k").alias("close"), F.sum("n").alias("volume"), F.sum(F.col("p") * F.col("n")).alias("amount"))


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, value and first of every line of the text files at path: `first` is true for the line that begins its file,
    however the file is split (line by line a split knows the offset of its own first byte)."""
    rows = spark.read.text(path)
    rows = rows.select(F.input_file_name().alias("file"), "value", F.input_file_block_start().alias("at"), F.monotonically_increasing_id().alias("n"))
    # the smallest running number among the lines of the split that begins at byte 0
    first = rows.filter("at = 0").groupBy("file").agg(F.min("n").alias("first_n"))
    return rows.join(first, "file", "left").select("file", "value", (F.col("n") == F.col("first_n")).alias("first"))


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """The files at path as Spark lists them, empty ones too, which a scan passes over."""
    return spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "file string")


def read_klines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC2, SRC3: 12 positional columns to bars with their file; and the refused files with why: empty (no byte but white
    space), no_rows (a header alone), not_a_number (any field of a row below the first line, in any column that is read).

    The first line of a file is its header if its first field is no number, and a row otherwise; no other line is skipped.
    A refused file gives no bars.
    """
    names = [c for c in KLINE if c not in ("close_time", "ignore")]
    lines = lines_of(spark, path).filter("trim(value) <> ''")
    part = F.split("value", ",")
    field = lambda i: F.trim(F.regexp_replace(F.coalesce(F.get(part, F.lit(i)), F.lit("")), '^"|"$', ""))
    rows = lines.select("file", "first", *(field(KLINE.index(c)).try_cast("double").alias(c) for c in names))
    header = F.col("first") & F.col("open_time").isNull()
    bad = F.greatest(*(F.col(c).isNull() for c in names))
    found = rows.groupBy("file").agg(F.count_if(~header).alias("rows"), F.count_if(~header & bad).alias("bad_rows"), F.max("open_time").alias("largest"))
    files = file_list(spark, path).select("file").join(found, "file", "left")
    why = F.when(F.col("rows").isNull(), "empty").when(F.col("rows") == 0, "no_rows").when(F.col("bad_rows") > 0, "not_a_number")
    files = files.select("file", "largest", F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"), why.alias("why"))
    good = rows.filter(~header).join(files.filter("why is null").select("file", "largest"), "file")
    bars = good.select(
        "file", millis(F.col("open_time").cast("long"), F.col("largest").cast("long")).alias("ts"), "open", "high", "low", "close", "volume", F.col("quote_volume").alias("amount"),
        F.col("n_trades").cast("long").alias("n_trades"), "taker_buy_volume", "taker_buy_quote_volume",
    )
    return bars, files.filter("why is not null").select("file", "why", "bad_rows")


def read_daily_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC4: lines TICKER,PER,DATE,TIME,OPEN,HIGH,LOW,CLOSE,VOL,OPENINT to bars with a synthesized amount (SRC7); and
    counts per file, with `failed` where more than one line in a thousand is malformed. The market tag .US is no part of
    the symbol, any other suffix is (BRK.A); source_symbol keeps the ticker as it stands."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value")).filter("trim(value) <> '' and value not like '<%'")
    part = F.split("value", ",")
    cols = {c: F.expr(f"try_cast(get(split(value, ','), {i}) AS double)") for i, c in ((4, "open"), (5, "high"), (6, "low"), (7, "close"), (8, "volume"))}
    rows = lines.select("file", F.get(part, F.lit(0)).alias("ticker"), F.get(part, F.lit(1)).alias("per"), F.expr("try_to_timestamp(get(split(value, ','), 2), 'yyyyMMdd')").alias("d"), *(v.alias(k) for k, v in cols.items()))
    bad = F.coalesce((F.col("per") != "D") | F.col("d").isNull() | F.greatest(*(F.col(c).isNull() for c in cols)), F.lit(True))
    rows = rows.withColumn("bad", bad)
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("bad").cast("int")).alias("malformed"))
    counts = counts.withColumn("failed", F.col("malformed") > MALFORMED * F.col("lines"))
    day = F.expr("datediff(cast(d as date), date'1970-01-01')").cast("long") * DAY
    bars = rows.filter("not bad").join(counts.filter("not failed").select("file"), "file")
    return bars.select("file", market_symbol(F.col("ticker")).alias("symbol"), F.col("ticker").alias("source_symbol"), day.alias("ts"), *cols, synthesized_amount().alias("amount")), counts


def market_symbol(ticker: Column) -> Column:
    """The ticker in upper case without the market tag .US."""
    return F.regexp_replace(F.upper(ticker), r"\.US$", "")


def synthesized_amount() -> Column:
    return F.col("volume") * (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4


def shard(symbol: Column) -> Column:
    """SNK2: first letter or digit in upper case, else an underscore; an empty symbol is an error."""
    first = F.substring(symbol, 1, 1)
    return F.when(F.length(symbol) == 0, F.raise_error(F.lit("empty symbol"))).when(first.rlike("[A-Za-z0-9]"), F.upper(first)).otherwise("_")


def write_bars(bars: DataFrame, path: str) -> None:
    """SNK1: one place per series, in order of time."""
    out = bars.repartition(*SERIES).sortWithinPartitions(*SERIES, "ts")
    out.write.option("compression", "zstd").partitionBy("source", "market", "frequency").parquet(path)
