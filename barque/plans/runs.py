"""Queries over runs, calendars, artifacts and manifests, each with SQL of the same result where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from barque.operators import adjust, clean, features, registry, runs
from barque.plans import queries as q
from barque.plans.catalog import QUERIES, SQL, query
from barque.plans.scratch import emptied, folder, kept
from barque.sources import bars as sources

H, D = q.H, q.D


_DAYS = f"SELECT DISTINCT CAST(o_orderpriority AS VARCHAR) AS exchange, epoch_ms(o_orderdate) // {D} AS day FROM orders"
_CALENDAR = f"SELECT exchange, day, row_number() OVER (PARTITION BY exchange ORDER BY day) AS ordinal FROM ({_DAYS})"
_CUSTOMER = "CASE WHEN c_acctbal < 0 THEN 'yahoo' WHEN c_custkey % 3 = 0 THEN 'stooq' ELSE 'feed' END"


@query(f"""WITH cal AS ({_CALENDAR}), bars AS (SELECT CAST(o_orderpriority AS VARCHAR) AS exchange, CAST(o_orderstatus AS VARCHAR) AS symbol, (epoch_ms(o_orderdate) // {D}) * {D} AS ts, count(*) AS n FROM orders GROUP BY 1, 2, 3)
SELECT exchange, symbol, ts, CAST(ordinal AS INTEGER) AS ordinal, CAST(CASE WHEN lag(ordinal) OVER w IS NULL THEN 0 ELSE greatest(ordinal - lag(ordinal) OVER w - 1, 0) END AS INTEGER) AS missing
FROM bars JOIN cal USING (exchange) WHERE cal.day = ts // {D} WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ts)""")
def calendar_gaps_orders(spark, d):
    """The days on which a priority has orders are its calendar; the series are its order states."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    day = F.expr("datediff(cast(o_orderdate as date), date'1970-01-01')").cast("long")
    rows = orders.select(F.col("o_orderpriority").alias("exchange"), F.col("o_orderstatus").alias("symbol"), day.alias("day"))
    bars = rows.groupBy("exchange", "symbol", (F.col("day") * D).alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    out = runs.calendar_gaps(bars, runs.calendar_of(rows, ["exchange"]), ["exchange", "symbol"], ["exchange"])
    return out.select("exchange", "symbol", "ts", "ordinal", "missing")


@query(f"SELECT symbol, count(*) AS n, sum(CAST(ts >= 1706745600000 - 1460::BIGINT * {D} AS BIGINT))::BIGINT AS recent FROM ({q.L_SQL}) WHERE ts >= 694224000000 AND ts < 820454400000 GROUP BY 1")
def year_clip_lineitem(spark, d):
    """Bars of 1992 to 1995, and how many of them a look back over four years from February 2024 would keep."""
    bars = runs.clipped(q.daily(spark, d), 694_224_000_000, 820_454_400_000)
    recent = runs.lookback(bars, 1_706_745_600_000, 4).groupBy("symbol").agg(F.count(F.lit(1)).alias("recent"))
    return bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).join(recent, "symbol", "left").fillna(0)


@query(f"""SELECT artifact, source, coalesce(CASE WHEN source = 'feed' AND asset_class = 'BUILDING' THEN '24x5-cfd' END, session, CASE WHEN source = 'stooq' THEN 'XNYS-regular' ELSE '24x7' END) AS session FROM
(SELECT CASE WHEN c_custkey % 10 = 0 THEN 'clean/' ELSE 'raw/' END || c_custkey AS artifact, {_CUSTOMER} AS source, c_mktsegment AS asset_class, CASE WHEN c_custkey % 4 = 0 THEN '24x5' END AS session FROM customer) WHERE source <> 'yahoo' AND artifact NOT LIKE 'clean/%'""")
def artifact_sessions_customer(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("concat(CASE WHEN c_custkey % 10 = 0 THEN 'clean/' ELSE 'raw/' END, c_custkey) AS artifact", f"{_CUSTOMER} AS source", "c_mktsegment AS asset_class", "CASE WHEN c_custkey % 4 = 0 THEN '24x5' END AS session")
    classes = rows.select("source", "asset_class").distinct()
    fallback = classes.withColumn("session", F.when(F.col("source") == "stooq", "XNYS-regular").otherwise("24x7"))
    override = classes.filter("source = 'feed' and asset_class = 'BUILDING'").withColumn("session", F.lit("24x5-cfd"))
    return runs.with_session(runs.bar_artifacts(rows), fallback, override).select("artifact", "source", "session")


@query(f"SELECT {_CUSTOMER} AS source, count(*) AS artifacts, CAST(sum(coalesce(bytes, 0)) AS BIGINT) AS bytes FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(length(o_orderstatus || o_orderpriority)) AS BIGINT) AS bytes FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1")
def storage_customer(spark, d):
    """Customers as artifacts; the text of their orders as their files."""
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey AS artifact", f"{_CUSTOMER} AS source")
    files = spark.read.parquet(f"{d}/orders.parquet").groupBy(F.col("o_custkey").alias("artifact")).agg(F.sum(F.length(F.concat("o_orderstatus", "o_orderpriority"))).alias("bytes"))
    return runs.storage(runs.with_sizes(rows, files))


@query("SELECT market, symbol, frequency FROM (SELECT n_name AS market, CAST(c_custkey AS VARCHAR) AS symbol, row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer JOIN nation ON c_nationkey = n_nationkey), (VALUES ('1h'), ('1d')) f(frequency) WHERE rank <= 5")
def work_list_customer(spark, d):
    from pyspark.sql import Window

    rows = spark.read.parquet(f"{d}/customer.parquet").join(spark.read.parquet(f"{d}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    rank = F.row_number().over(Window.partitionBy("n_name").orderBy(F.desc("c_acctbal"), "c_custkey"))
    listing = rows.select(F.col("n_name").alias("market"), F.col("c_custkey").cast("string").alias("symbol"), rank.alias("rank"))
    return runs.work_list(listing, spark.sql("SELECT explode(array('1h', '1d')) AS frequency"), ["market"], 5)


@query("SELECT CAST(l_linenumber AS VARCHAR) AS symbol, event_type, count(*) AS n, round(sum(value), 4) AS value FROM (SELECT l_linenumber, unnest([struct_pack(event_type := 'dividend', value := CAST(l_discount AS DOUBLE)), struct_pack(event_type := 'split', value := CASE WHEN l_returnflag = 'R' THEN 2.0::DOUBLE ELSE 0::DOUBLE END)], recursive := true) FROM lineitem) WHERE value <> 0 GROUP BY 1, 2")
def corporate_events_lineitem(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    pair = F.array(F.struct(F.lit("dividend").alias("event_type"), F.col("l_discount").cast("double").alias("value")), F.struct(F.lit("split").alias("event_type"), F.when(F.col("l_returnflag") == "R", 2.0).otherwise(0.0).alias("value")))
    raw = rows.select(F.col("l_linenumber").cast("string").alias("symbol"), F.col("l_shipdate").alias("ts"), F.inline(pair))
    return runs.corporate_events(raw, ["symbol"]).groupBy("symbol", "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query(f"{q._stats_of(q.E_SQL, q.RULE)} SELECT count(*) AS series, CAST(sum(total_bars) AS BIGINT) AS bars, CAST(sum(kept_bars) AS BIGINT) AS kept FROM (SELECT DISTINCT symbol, total_bars, kept_bars FROM stats)")
def clean_coverage_events(spark, d):
    return runs.clean_coverage(clean.drop_stats(q.hourly(spark, d), ["symbol"], q.RULE), [], "symbol")


_FAULTS = "SELECT symbol FROM (SELECT symbol, sum(n_bars) AS n, count(*) FILTER (start_ts = 0) AS odd FROM faulty GROUP BY 1) JOIN (SELECT DISTINCT symbol, total_bars, kept_bars FROM stats) USING (symbol) WHERE n <> kept_bars OR odd > 0"


@query(f"{q._stats_of(q.E_SQL, q.RULE)}, faulty AS (SELECT symbol, count(*) + CASE WHEN symbol = 'view' THEN 1 ELSE 0 END AS n_bars, CASE WHEN symbol = 'click' THEN 0 ELSE min(ts) END AS start_ts FROM kept GROUP BY symbol, piece) {_FAULTS}")
def series_invariants_events(spark, d):
    """Series that break the accounting between segments and drop statistics. One has a bar too many planted in its segments,
    one a first segment that begins before its first bar, beside whatever is unsound by itself."""
    bars = q.hourly(spark, d)
    segs = clean.segments(bars, ["symbol"], q.RULE)
    segs = segs.withColumn("n_bars", F.col("n_bars") + (F.col("symbol") == "view").cast("int")).withColumn("start_ts", F.when(F.col("symbol") == "click", 0).otherwise(F.col("start_ts")))
    return runs.series_invariants(clean.drop_stats(bars, ["symbol"], q.RULE), segs, ["symbol"], bars).select("symbol")


@query(f"SELECT feature, round(clipped / n, 8) AS clip_rate FROM ({SQL['clip_table_events']}) WHERE clipped / n > 0.0005")
def clip_flags_events(spark, d):
    flags = runs.clip_flags(QUERIES["clip_table_events"](spark, d), ["feature"], 0.0005)
    return flags.withColumn("clip_rate", F.round("clip_rate", 8))


@query(f"{q._stats_of(q.E_SQL, q.RULE)} SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'reused') AS reused, CAST(sum(segments) AS BIGINT) AS segments, CAST(sum(total_bars) AS BIGINT) AS total_bars, CAST(sum(kept_bars) AS BIGINT) AS kept_bars, CAST(sum(total_bars) - sum(kept_bars) AS BIGINT) AS dropped_bars, round(sum(kept_bars) / sum(total_bars), 8) AS coverage FROM (SELECT symbol, max(total_bars) AS total_bars, max(kept_bars) AS kept_bars, (SELECT count(DISTINCT piece) FROM kept k WHERE k.symbol = s.symbol) AS segments, CASE WHEN max(kept_bars) > 0 THEN 'ok' ELSE 'failed' END AS status FROM stats s GROUP BY symbol)")
def run_totals_events(spark, d):
    """A series that keeps no bar counts as failed here."""
    bars = q.hourly(spark, d)
    stats = clean.drop_stats(bars, ["symbol"], q.RULE).groupBy("symbol").agg(F.max("total_bars").alias("total_bars"), F.max("kept_bars").alias("kept_bars"))
    segs = clean.segments(bars, ["symbol"], q.RULE).groupBy("symbol").agg(F.count(F.lit(1)).alias("segments"))
    rows = stats.join(segs, "symbol", "left").fillna(0).withColumn("status", F.when(F.col("kept_bars") > 0, "ok").otherwise("failed"))
    return runs.run_totals(rows).withColumn("coverage", F.round("coverage", 8))


@query("""WITH s AS (SELECT n_name AS market, CASE WHEN c_mktsegment = 'BUILDING' THEN 'split+dividend' ELSE 'accumulate' END AS verdict, CASE WHEN c_custkey % 4 <> 0 THEN (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) END AS n FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT *, verdict = 'split+dividend' OR n IS NOT NULL AS ok FROM s)
SELECT market, count(*) AS tickers, count(*) FILTER (ok) AS available, round_even(100.0 * count(*) FILTER (ok) / count(*), 3) AS pct, count(n) AS with_events, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (n = 0) AS without_an_event FROM t GROUP BY 1""")
def tr_coverage_customer(spark, d):
    """Customers as tickers, their orders as events; of every fourth customer no events were captured, and a captured one
    may have none."""
    rows = spark.read.parquet(f"{d}/customer.parquet").join(spark.read.parquet(f"{d}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    series = rows.select(F.col("n_name").alias("market"), "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "split+dividend").otherwise("accumulate").alias("verdict"))
    manifests = rows.filter("c_custkey % 4 <> 0").select("c_custkey", F.lit("yahoo").alias("source"), F.lit("events").alias("kind"))
    events = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("c_custkey"))
    return runs.tr_coverage(runs.with_events(series, events, runs.captures(manifests, ["c_custkey"]), ["c_custkey"]), ["market"])


@query("""SELECT s_suppkey, sha256('{"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || ',"s_suppkey":' || s_suppkey || '}') AS identity FROM supplier""")
def identity_hashes_supplier(spark, d):
    """The balance is volatile: the hash doesn't move with it."""
    rows = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return runs.identity_hash(rows, ["s_acctbal"]).select("s_suppkey", "identity")


@query(f"SELECT symbol, ts, round(open, 4) AS open, round(close, 4) AS close, round(volume, 4) AS volume, round(amount, 3) AS amount, CAST(NULL AS BIGINT) AS n_trades FROM ({q.E_SQL})")
def inverse_table_events(spark, d):
    """Features of every bar and back: the bars themselves, the anchor first."""
    bars = kept(q.hourly(spark, d), "inverse_table_events")
    raw = features.raw_features(bars, ["symbol"])
    anchors = bars.groupBy("symbol").agg(F.min_by(F.struct("ts", "open", "high", "low", "close", "volume", "amount"), "ts").alias("a")).select("symbol", "a.*")
    out = runs.inverse_table(anchors, features.inverse_prices(raw, anchors, ["symbol"]), features.inverse_flows(raw, anchors, ["symbol"]), ["symbol"])
    return q.rounded(q.rounded(out, ["open", "close", "volume"], 4), ["amount"], 3).select("symbol", "ts", "open", "close", "volume", "amount", "n_trades")


@query("SELECT source, count(*) AS n, count(*) FILTER (bad) AS failed_rows FROM (SELECT source, n_chars IS NULL OR n_chars < 40 AS bad FROM documents) GROUP BY 1")
def isolated_documents(spark, d):
    """Sources with a bad row fail whole; the counts of both sides add up to the table."""
    rows = spark.read.parquet(f"{d}/documents.parquet").select("source", "n_chars")
    good, failures = runs.isolated(rows, F.col("n_chars") >= 40, ["source"])
    failed = rows.join(failures, "source").groupBy("source", "bad_rows").agg(F.count(F.lit(1)).alias("n")).select("source", "n", F.col("bad_rows").alias("failed_rows"))
    return failed.unionByName(good.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("failed_rows", F.lit(0).cast("long")))


@query(f"SELECT symbol, ts, round(volume * (open + high + low + close) / 4, 4) AS amount, CAST(NULL AS BIGINT) AS n_trades FROM ({q.E_SQL})")
def frames_events(spark, d):
    """Bars as frames in nanoseconds, and back."""
    frames = q.hourly(spark, d).drop("amount").withColumn("ts", F.col("ts") * 1_000_000)
    return q.rounded(runs.frames_to_bars(frames), ["amount"], 4).select("symbol", "ts", "amount", "n_trades")


@query(f"SELECT symbol, ts, open, high, low, close, volume, round(amount, 4) AS amount FROM ({q.E_SQL})")
def stored_bars_events(spark, d):
    """Written as the bar tier and scanned again."""
    at = emptied(spark, folder(spark, "stored_bars_events"))
    bars = q.hourly(spark, d)
    none = {c: F.lit(None).cast(kind) for c, kind in (("n_trades", "long"), ("taker_buy_volume", "double"), ("taker_buy_quote_volume", "double"))}
    sources.write_bars(bars.withColumns({c: F.lit(v) for c, v in (("source", "events"), ("market", "m"), ("asset_class", "x"), ("frequency", "1h"), ("session_id", "24x7"))} | none), at)
    back = sources.read_bars(spark, at).filter("source = 'events' and frequency = '1h'")
    return q.rounded(back.select("symbol", "ts", "open", "high", "low", "close", "volume", "amount"), ["amount"], 4)


@query(f"SELECT symbol, ts, open, high, low, close, volume, round(amount, 4) AS amount FROM ({q.E_SQL})")
def klines_events(spark, d):
    """Bars as positional text in microseconds, a folder for each series, and read back."""
    at = emptied(spark, folder(spark, "klines_events"))
    line = F.concat_ws(",", (F.col("ts") * 1000).cast("string"), *("open", "high", "low", "close", "volume"), F.col("ts").cast("string"), "amount", F.lit("1"), F.lit("0.5"), F.lit("0.5"), F.lit("0"))
    q.hourly(spark, d).select("symbol", line.alias("value")).repartition("symbol").write.partitionBy("symbol").text(at)
    bars, _ = sources.read_klines(spark, f"{at}/*")
    back = bars.select(F.regexp_extract("file", "symbol=([^/]*)", 1).alias("symbol"), "ts", "open", "high", "low", "close", "volume", "amount")
    return q.rounded(back, ["amount"], 4)


@query(f"SELECT symbol, ts, round(open, 4) AS open, round(close, 4) AS close, round(volume * (open + high + low + close) / 4, 4) AS amount FROM ({q._bars_sql('orders', 'upper(left(o_orderpriority, 1))', 'o_orderdate', 'o_totalprice', '1', 'o_orderkey', D)})")
def daily_text_orders(spark, d):
    """Daily bars as comma-separated text under a header line, and read back."""
    at = emptied(spark, folder(spark, "daily_text_orders"))
    bars = sources.bars_from_ticks(spark.read.parquet(f"{d}/orders.parquet").withColumn("o_orderpriority", F.upper(F.expr("left(o_orderpriority, 1)"))), "o_orderpriority", "o_orderdate", "o_totalprice", "1", "o_orderkey", D)
    day = F.expr("date_format(timestamp_millis(ts), 'yyyyMMdd')")
    line = F.concat_ws(",", F.concat("symbol", F.lit(".us")), F.lit("D"), day, F.lit("000000"), "open", "high", "low", "close", "volume", F.lit("0"))
    lines = bars.select("symbol", line.alias("value")).unionByName(bars.select("symbol", F.lit("<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>").alias("value")).distinct())
    lines.repartition("symbol").write.partitionBy("symbol").text(at)
    back, _ = sources.read_daily_text(spark, f"{at}/*")
    return q.rounded(back.select("symbol", "ts", "open", "close", "amount"), ["open", "close", "amount"], 4)


@query("""WITH l AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'B' || (c_custkey // 5) || 'UP' ELSE 'B' || c_custkey END || CASE WHEN c_custkey % 7 = 0 THEN 'USD' ELSE 'USDT' END AS symbol FROM customer), b AS (SELECT symbol, left(symbol, length(symbol) - 4) AS base FROM l WHERE symbol LIKE '%USDT')
SELECT DISTINCT symbol, base FROM b WHERE base NOT IN ('B1', 'B2') AND NOT (regexp_matches(base, '(UP|DOWN|BULL|BEAR)$') AND length(regexp_replace(base, '(UP|DOWN|BULL|BEAR)$', '')) >= 2 AND regexp_replace(base, '(UP|DOWN|BULL|BEAR)$', '') IN (SELECT base FROM b))""")
def crypto_candidates_customer(spark, d):
    """Customers as symbols, every fifth a leveraged version of another; two bases are excluded, but still name others."""
    symbol = "concat(CASE WHEN c_custkey % 5 = 0 THEN concat('B', c_custkey div 5, 'UP') ELSE concat('B', c_custkey) END, CASE WHEN c_custkey % 7 = 0 THEN 'USD' ELSE 'USDT' END) AS symbol"
    return registry.candidates(spark.read.parquet(f"{d}/customer.parquet").selectExpr(symbol), "USDT", ["B1", "B2"]).distinct()


_SHIFT = 1.2345e-7  # off the ties of rounding


@query(f"""WITH bars AS ({q.L_SQL}),
later AS (SELECT symbol, ts, product(p) OVER (PARTITION BY symbol ORDER BY ts DESC) AS factor FROM (SELECT symbol, ts, product(value) AS p FROM ({q._SPLIT}) GROUP BY 1, 2)),
dividends AS (SELECT d.symbol, d.ts, d.value / coalesce(s.factor, 1.0) AS value FROM ({q._DIV}) d ASOF LEFT JOIN later s ON s.symbol = d.symbol AND d.ts < s.ts),
placed AS (SELECT e.symbol, b.ts, sum(e.value) AS d FROM dividends e ASOF JOIN bars b ON b.symbol = e.symbol AND e.ts <= b.ts GROUP BY 1, 2),
steps AS (SELECT symbol, ts, close, coalesce((close + coalesce(d, 0)) / lag(close) OVER (PARTITION BY symbol ORDER BY ts), 1) AS step FROM bars LEFT JOIN placed USING (symbol, ts))
SELECT symbol, ts, close, round(first_value(close) OVER w * product(step) OVER w / close + {_SHIFT}, 6) AS tr_factor FROM steps WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
def total_return_splits_lineitem(spark, d):
    """Dividends are brought to the bars' scale by the splits after them; the price over the close, as total_return_lineitem."""
    out = adjust.total_return(q.daily(spark, d), q._dividends(spark, d), ["symbol"], q._splits(spark, d))
    return out.select("symbol", "ts", "close", F.round(F.col("tr_close") / F.col("close") + _SHIFT, 6).alias("tr_factor"))

