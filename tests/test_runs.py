"""Calendars, sessions, manifests, publication: the refusals and the cases that the queries over given tables don't meet."""

import pytest
from pyspark.sql import functions as F

from barque.functions import sessions
from barque.operators import adjust, features, registry, runs

DAY = sessions.DAY


def test_calendar_counts_sessions_and_refuses_other_days(spark):
    calendar = runs.calendar_of(spark.createDataFrame([("X", d) for d in (-3, -2, 1, 2, 2, 6)], "exchange string, day long"), ["exchange"])
    bars = spark.createDataFrame([("X", "a", d * DAY) for d in (-3, 1, 6)] + [("X", "b", -2 * DAY)], "exchange string, symbol string, ts long")
    got = runs.calendar_gaps(bars, calendar, ["exchange", "symbol"], ["exchange"]).orderBy("symbol", "ts").collect()
    assert [(r.symbol, r.ts // DAY, r.missing) for r in got] == [("a", -3, 0), ("a", 1, 1), ("a", 6, 1), ("b", -2, 0)]
    holiday = spark.createDataFrame([("X", "a", 0)], "exchange string, symbol string, ts long")
    with pytest.raises(Exception, match="outside the calendar"):
        runs.calendar_gaps(holiday, calendar, ["exchange", "symbol"], ["exchange"]).collect()
    for f in (sessions.open_prefix, lambda k, s: sessions.expected_open(F.col("ts"), k, s)):
        with pytest.raises(NotImplementedError):
            f("exchange_calendar", DAY)


def test_break_of_equal_hours_is_the_whole_day(spark):
    rows = spark.range(24).withColumn("ts", F.col("id") * sessions.HOUR)
    count = lambda a, b: rows.filter(sessions.daily_break(F.col("ts"), a, b)).count()
    assert [count(21, 22), count(22, 2), count(5, 5), count(-1, 3)] == [1, 4, 24, 0]
    assert sessions.open_prefix("weekend", sessions.HOUR, (5, 5))[-1] == 0


def test_leveraged_by_an_excluded_base(spark):
    listing = spark.createDataFrame([(s,) for s in ("EURUSDT", "EURUPUSDT", "SYRUPUSDT", "BTCUSDT", "BTCDOWNUSDT", "UPUSDT")], "symbol string")
    assert {r.base for r in registry.candidates(listing, "USDT", ["EUR"]).collect()} == {"SYRUP", "BTC", "UP"}


def test_sessions_lists_and_events_refuse(spark):
    artifacts = spark.createDataFrame([("raw/1", "s", "fx", None), ("raw/2", "s", "etf", "24x5")], "artifact string, source string, asset_class string, session string")
    none = spark.createDataFrame([], "source string, asset_class string, session string")
    back = spark.createDataFrame([("s", "fx", "24x7")], none.schema)
    assert {r.artifact: r.session for r in runs.with_session(artifacts, back, none).collect()} == {"raw/1": "24x7", "raw/2": "24x5"}
    over = spark.createDataFrame([("s", "etf", "XNYS")], none.schema)
    assert {r.session for r in runs.with_session(artifacts, back, over).collect()} == {"24x7", "XNYS"}
    with pytest.raises(Exception, match="no session for s/fx"):
        runs.with_session(artifacts, none, none).collect()
    with pytest.raises(Exception, match="stands twice"):
        runs.pinned(spark.createDataFrame([("a",), ("b",), ("a",)], "symbol string")).collect()
    with pytest.raises(Exception, match="unknown event type"):
        runs.corporate_events(spark.createDataFrame([("a", 1, "merger", 1.0)], "symbol string, ts long, event_type string, value double"), ["symbol"]).collect()
    with pytest.raises(Exception, match="unknown source"):
        runs.with_literals(spark.createDataFrame([("zzz", 1)], "source string, ts long"), spark.createDataFrame([("s", "bid")], "source string, price_side string")).collect()
    with pytest.raises(Exception, match="unknown verdict"):
        spark.range(1).select(runs.tr_available(F.lit("odd"), F.lit(True))).collect()


def test_constants_output(spark):
    rows = spark.createDataFrame([("s", "f", 1 / 3, 2e-9 / 7), ("s", "g", 1.0, 2.0)], "slice string, feature string, center double, scale double")
    got = {r.feature: (r.center, r.scale) for r in runs.constants_output(rows, ["slice"], ["f", "g"]).collect()}
    assert got == {"f": (0.333333333333, 2.85714285714e-10), "g": (1.0, 2.0)}
    with pytest.raises(Exception, match="lacks a feature"):
        runs.constants_output(rows, ["slice"], ["f", "g", "h"]).collect()


def test_identity_hash_and_pairs(spark):
    rows = spark.createDataFrame([("a", 1, None, "2024"), ("a", 1, None, "2025"), ("a", 2, "x", "2024")], "b string, a int, z string, created string")
    got = [r.identity for r in runs.identity_hash(rows, ["created"]).collect()]
    assert got[0] == got[1] != got[2]
    lists = spark.createDataFrame([(1, ["u"], ["h"]), (2, ["u", "v"], ["h"]), (3, None, ["h"])], "id int, source_urls array<string>, source_sha256s array<string>")
    assert {r.id for r in runs.paired(lists).collect()} == {2, 3}


def test_content_hash_is_of_rows_as_a_multiset(spark):
    rows = [("a", 1, 0.5), ("a", 2, None), ("a", 2, None), ("b", 1, 0.5)]
    frame = lambda r: spark.createDataFrame(r, "k string, n int, x double")
    of = lambda df: {r.k: r.content_hash for r in registry.content_hash(df, ["k"]).collect()}
    assert of(frame(rows)) == of(frame(rows[::-1]).repartition(3)) and of(frame(rows))["a"] != of(frame(rows[:2] + rows[3:]))["a"]


def test_features_over_many_batches(spark):
    rows = [(s, i, 1.0 + i % 7, 2.0 + i % 7, 0.5 + i % 7, 1.5 + i % 7, float(i * i % (101 + ord(s))), float(i * i * i % 103)) for s, n in (("s", 1000), ("t", 1), ("u", 299), ("v", 2)) for i in range(n)]
    bars = spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume double, amount double").repartition(5)
    import numpy as np

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        plan = features.raw_features(bars, ["symbol"])
        got = {(r.symbol, r.ts): r.rel_volume for r in plan.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 999 + 298 + 1
    for s in "su":
        lv = np.log1p([r[6] for r in rows if r[0] == s])
        assert all(got[s, i] == pytest.approx(lv[i] - np.median(lv[max(0, i - 256) : i])) for i in range(1, len(lv)))
    tree = plan._jdf.queryExecution().executedPlan().toString().rpartition("Initial Plan")[2]
    assert tree.count("Exchange hashpartitioning") == 1 and tree.count("Sort [") == 1


def test_total_return_divides_by_later_splits(spark):
    bars = spark.createDataFrame([("s", i, c) for i, c in enumerate((10.0, 10.0, 5.0, 5.0))], "symbol string, ts long, close double")
    dividends = spark.createDataFrame([("s", 1, 1.0), ("s", 9, 7.0)], "symbol string, ts long, value double")
    splits = spark.createDataFrame([("s", 2, 2.0)], "symbol string, ts long, value double")
    tr = lambda *x: [r.tr_close for r in adjust.total_return(bars, dividends, ["symbol"], *x).orderBy("ts").collect()]
    assert tr() == pytest.approx([10, 11, 5.5, 5.5]) and tr(splits) == pytest.approx([10, 10.5, 5.25, 5.25])


def test_failures_stay_alone(spark):
    rows = spark.createDataFrame([("f", 1), ("f", None), ("g", 2)], "file string, x int")
    good, failures = runs.isolated(rows, F.col("x") > 0, ["file"])
    assert [r.file for r in good.collect()] == ["g"] and [tuple(r) for r in failures.collect()] == [("f", 1)]
    assert runs.run_totals(spark.createDataFrame([], "status string, segments long, total_bars long, kept_bars long")).first().coverage is None
