"""Streams of bars: causal features with state per series, and rule breaks by window (STR1, STR2).

On the same bars both equal the batch operators. Features keep a series' last bar and its PAST logged flows; a timer in
event time drops the state of a series that has been silent for long. Bars that come after later ones of their series are
never used: they go to a sink of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barque.functions.sessions import DAY
from barque.operators.features import PAST

OUTPUT = "symbol string, ts long, late boolean, gap double, body double, upper double, lower double, rel_volume double, rel_amount double"
NAMES = [x.split()[0] for x in OUTPUT.split(", ")]
SILENT = 30 * DAY  # after so long without a bar a series begins anew
CENTURY = 36_526 * DAY  # whole weeks; a stream's first watermark is 1970, and bars may be older
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LiveFeatures(StatefulProcessor):
    """Value state: the last bar's ts and close. List state: the last PAST logged volumes and amounts, oldest first."""

    def __init__(self, silent_ms: int = SILENT):
        self.silent_ms = silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, close double")
        self.flows = handle.getListState("flows", "lv double, la double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bars = pd.concat(list(rows)).sort_values("ts", kind="stable")
        last, close = self.last.get() if self.last.exists() else (None, None)
        past = pd.DataFrame([tuple(x) for x in self.flows.get()] if last is not None else [], columns=["lv", "la"], dtype=float)
        ts = bars["ts"].to_numpy()
        seen = np.concatenate(([np.iinfo(np.int64).min if last is None else last], ts[:-1]))
        late = ts <= np.maximum.accumulate(seen)  # equal times too: the first of them counts
        old, new = bars[late], bars[~late]
        if len(new):
            flows = pd.DataFrame({"lv": np.log1p(new["volume"].to_numpy()), "la": np.log1p(new["amount"].to_numpy())})
            both = pd.concat([past, flows], ignore_index=True)
            medians = both.shift(1).rolling(PAST, min_periods=1).median().iloc[len(past) :].to_numpy()
            before = np.concatenate(([np.nan if close is None else close], new["close"].to_numpy()[:-1]))
            o = new["open"].to_numpy()
            out = pd.DataFrame({"symbol": key[0], "ts": new["ts"].to_numpy(), "late": False, "gap": np.log(o / before), "body": np.log(new["close"].to_numpy() / o), "upper": np.log(new["high"].to_numpy() / o), "lower": np.log(new["low"].to_numpy() / o)})
            out["rel_volume"], out["rel_amount"] = flows["lv"].to_numpy() - medians[:, 0], flows["la"].to_numpy() - medians[:, 1]
            self.last.update((int(new["ts"].iloc[-1]), float(new["close"].iloc[-1])))
            self.flows.put([tuple(x) for x in both.iloc[-PAST:].itertuples(index=False)])
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(new["ts"].iloc[-1]) + CENTURY + self.silent_ms)
            yield out[out["gap"].notna()][NAMES] if close is None else out[NAMES]  # a series' first bar is only an anchor
        if len(old):
            yield pd.DataFrame({"symbol": key[0], "ts": old["ts"].to_numpy(), "late": True} | dict.fromkeys(NAMES[3:], np.nan))[NAMES]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.last.clear()
        self.flows.clear()
        yield pd.DataFrame({n: pd.Series(dtype="object") for n in NAMES})

    def close(self) -> None:
        pass


def live_features(bars: DataFrame, delay: str = "7 days", silent_ms: int = SILENT) -> DataFrame:
    """STR1: a stream of bars (symbol, ts, open, high, low, close, volume, amount) to feature rows. Bars older than the
    watermark, `delay` behind the latest, are gone before they get here; those older than their series' last are `late`."""
    rows = bars.withColumn("at", F.timestamp_millis(F.col("ts") + CENTURY)).withWatermark("at", delay)
    return rows.groupBy("symbol").transformWithStateInPandas(LiveFeatures(silent_ms), OUTPUT, "Append", "EventTime")


def two_sinks(path: str):
    """For foreachBatch: features and late bars to folders of their own, one folder a batch, so that a batch that is run
    again writes over itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.filter("not late").drop("late").write.mode("overwrite").parquet(f"{path}/features/batch={number}")
        batch.filter("late").select("symbol", "ts").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        batch.unpersist()

    return write


@contextmanager
def state_in_rocks(spark: SparkSession):
    """Queries started here keep their state in RocksDB, as list states and timers need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_available(features: DataFrame, path: str) -> None:
    """Work off what has come and end; the next call goes on from the checkpoint under path."""
    with state_in_rocks(features.sparkSession):
        features.writeStream.foreachBatch(two_sinks(path)).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def validation_counts(bars: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """STR2: bars and rule breaks per series and tumbling window of bar time. As a stream with append output: a window comes
    out once, when the watermark has passed its end, and its state goes; what comes for it later is dropped, and so is what is
    older than 1970, where a watermark begins."""
    rows = bars.withColumn("at", F.timestamp_millis("ts")).withWatermark("at", delay)
    return rows.groupBy("symbol", F.window("at", window)).agg(
        F.count(F.lit(1)).alias("bars"), F.count_if(F.col("high") < F.greatest("open", "close")).alias("high_below_open_or_close"),
        F.count_if(F.col("low") > F.least("open", "close")).alias("low_above_open_or_close"), F.count_if(F.col("volume") < 0).alias("volume_negative"),
    )


def count_available(counts: DataFrame, path: str) -> None:
    """Append the windows that are complete to path/counts, and end."""
    out = counts.select("symbol", F.unix_millis("window.start").alias("start"), *counts.columns[2:])
    out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/counts").awaitTermination()
