"""Queries against their SQL on small tables of cases that the given ones lack at the smallest scale."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from barque.operators import adjust, features, sketch
from barque.plans.catalog import QUERIES, SQL, load

load()

SF = "/root/testdata/sf0.001"


def norm(v):
    return round(float(v), 9) + 0.0 if isinstance(v, float) or hasattr(v, "is_finite") else v


def equal(spark, name, folder, tables):
    """The query's rows over the tables in folder, after they were held against those of its SQL."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](spark, str(folder))
    r = con.execute(SQL[name])
    columns = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(norm(x[c]) for c in columns) for x in df.collect()]
    want = [tuple(map(norm, x)) for x in r.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return [dict(zip(columns, x, strict=True)) for x in got]


def test_most_cut_has_the_columns_of_its_sql(spark):
    assert equal(spark, "most_cut_events", SF, ["events"])


def ticks(spark, folder, price, hours=40):
    """events of two series with three or four ticks an hour; price: of series, hour and tick."""
    rows = [(4 * (hours * s + h) + i, h, i, s, ("click", "view")[s], float(price(s, h, i))) for s in (0, 1) for h in range(hours) for i in range(4) if h % 3 or i < 3]
    df = spark.createDataFrame(rows, "event_id long, h int, i int, user_id long, event_type string, value double")
    ts = "cast(timestampadd(MINUTE, 60 * h + 10 * i, timestamp_ntz'2024-01-08 00:00:00') AS timestamp_ntz) AS ts"
    df.selectExpr("event_id", ts, "user_id", "event_type", "value", "'{}' AS props").coalesce(1).write.parquet(f"{folder}/all")
    (part,) = (folder / "all").glob("*.parquet")
    part.rename(folder / "events.parquet")
    return folder


def wave(s, h, i):
    return 100 + s + (h * 7 + i * 5) % 11


def late_ticks(spark, folder):
    """Ticks of which the fourth of an hour comes some microseconds before the hour ends."""
    (folder / "plain").mkdir()
    ticks(spark, folder / "plain", wave, 41)
    df = spark.read.parquet(f"{folder}/plain/events.parquet")
    at = "timestampadd(MICROSECOND, 3600000000 - element_at(array(1, 499, 500, 501, 999), cast(hour(ts) % 5 + 1 AS int)), date_trunc('HOUR', ts))"
    df.withColumn("ts", F.when(F.col("event_id") % 4 == 3, F.expr(f"cast({at} AS timestamp_ntz)")).otherwise(F.col("ts"))).coalesce(1).write.parquet(f"{folder}/late")
    (part,) = (folder / "late").glob("*.parquet")
    part.rename(folder / "events.parquet")
    return folder


LATE = ["bars_events", "bar_statistics_events", "bar_tier_events", "features_events", "frames_events", "inverse_events", "inverse_segments_events", "inverse_table_events", "klines_events", "leaky_zscore_events", "live_features_events", "sketch_events"]


@pytest.mark.parametrize("name", LATE)
def test_ticks_of_the_last_half_millisecond_of_an_hour(spark, tmp_path, name):
    assert equal(spark, name, late_ticks(spark, tmp_path), ["events"])


def test_session_predicates_of_the_last_half_millisecond(spark, tmp_path):
    """The query's clock is moved by 2e12 ms, so its hours end at 33:20 minutes."""
    times = [f"{y}-01-01 {h:02}:33:19.999{us}" for y in (1960, 2024) for h in (0, 7, 23) for us in (499, 500, 501, 999)]
    spark.createDataFrame(list(enumerate(times)), "event_id long, t string").selectExpr("event_id", "cast(t AS timestamp_ntz) AS ts").coalesce(1).write.parquet(f"{tmp_path}/all")
    (part,) = (tmp_path / "all").glob("*.parquet")
    part.rename(tmp_path / "events.parquet")
    assert len({r["hour"] for r in equal(spark, "session_predicates_events", tmp_path, ["events"])}) > 3


def low_of_zero(s, h, i):
    return 0.0 if (s, h, i) == (0, 34, 2) else wave(s, h, i)


def test_features_of_a_zero_price(spark, tmp_path):
    rows = equal(spark, "features_events", ticks(spark, tmp_path, low_of_zero), ["events"])
    assert len(rows) == 78 and [r["lower"] for r in rows].count(float("-inf")) == 1


def test_features_after_a_close_of_zero(spark, tmp_path):
    rows = equal(spark, "features_events", ticks(spark, tmp_path, lambda s, h, i: 0.0 if (s, h, i) == (1, 20, 3) else wave(s, h, i)), ["events"])
    assert [r["gap"] for r in rows].count(float("inf")) == 1 and [r["body"] for r in rows].count(float("-inf")) == 1


def test_a_low_of_zero_comes_back(spark, tmp_path):
    assert 0.0 in [r["low"] for r in equal(spark, "inverse_events", ticks(spark, tmp_path, low_of_zero), ["events"])]


def test_constants_and_clips_of_a_zero_price(spark, tmp_path):
    folder = ticks(spark, tmp_path, low_of_zero)
    for name in ("sketch_events", "fit_constants_events", "fit_constants_segments_events", "clip_table_events", "clip_flags_events"):
        rows = equal(spark, name, folder, ["events"])
        if name == "clip_flags_events":
            assert {r["feature"] for r in rows} >= {"lower", "ret_low"}


def test_bins_of_negative_values(spark):
    """A millionth on either side of a bin's edge, where x + sqrt(x * x + 1) cancels."""
    at = [(b, side, math.sinh(b * sketch.WIDTH - sketch.REACH + side * 1e-6) * sketch.UNIT) for b in range(5000, 7000, 7) for side in (-1, 1)]
    rows = spark.createDataFrame(at, "b int, side int, x double").withColumn("bin", sketch.bin_of(F.col("x"))).collect()
    assert all(r.bin == r.b - (r.side < 0) for r in rows)


@pytest.mark.parametrize("name", ["contract_features_events", "distribution_events", "contract_round_trip_events", "contract_qa_events", "contract_qa_faults_events", "fit_slices_events"])
def test_contract_of_a_zero_price(spark, tmp_path, name):
    rows = equal(spark, name, ticks(spark, tmp_path, low_of_zero, 60), ["events"])
    assert rows and all(r.get("off", 0) == 0 for r in rows)


def test_zero_prices_are_let_through_on_request_alone(spark):
    bars = spark.createDataFrame([(s, i, 2.0, 3.0, low, 2.0, 1.0, 1.0) for s, low in (("zero", 0.0), ("below", -1.0)) for i in range(3)], "symbol string, ts long, open double, high double, low double, close double, volume double, amount double")
    codes = lambda **how: {r.symbol: r.code for r in features.refusals(bars.withColumn("row", F.col("ts")), ["symbol"], **how).collect()}
    assert codes() == dict.fromkeys(("zero", "below"), "non_positive_price") and codes(zero_prices=True) == {"below": "non_positive_price"}


def below_windows(df):
    """The kinds of steps on each way from a window to a table."""

    def ways(plan, above):
        above = [*above, plan.nodeName()]
        below = plan.children()
        return [w for i in range(below.size()) for w in ways(below.apply(i), above)] if below.size() else [above]

    return [w[w.index("Window") :] for w in ways(df._jdf.queryExecution().optimizedPlan(), []) if "Window" in w]


def dated(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts long, value double")


def test_windows_hold_times_not_dividends_and_splits(spark):
    ways = below_windows(QUERIES["split_factor_lineitem"](spark, SF)) + below_windows(QUERIES["forward_asof_lineitem"](spark, SF))
    assert len(ways) >= 4 and all("Aggregate" in w for w in ways)


def test_factors_of_shared_and_null_times(spark):
    dividends = [("a", 1, 1.0), ("a", 1, 2.0), ("a", 5, 3.0), ("a", None, 4.0), (None, 1, 5.0), ("b", 9, 6.0), ("a", 1, 1.0), ("a", 5, None)]
    splits = [("a", 5, 2.0), ("a", 5, 3.0), ("a", 7, 5.0), (None, 2, 7.0), ("c", 9, 9.0), ("a", 7, None)]
    got = sorted((tuple(r) for r in adjust.split_factor(dated(spark, dividends), dated(spark, splits), ["symbol"]).collect()), key=repr)
    factors = {("a", 1): 30.0, ("a", 5): 5.0, ("a", None): 30.0, (None, 1): 7.0, ("b", 9): 1.0}
    assert got == sorted(((*d, factors[d[:2]]) for d in dividends), key=repr)


def test_events_of_shared_times_find_their_bars(spark):
    bars = dated(spark, [("a", 2, 0.0), ("a", 6, 0.0), (None, 3, 0.0)])
    events = dated(spark, [("a", 1, 1.0), ("a", 1, 1.0), ("a", 2, None), ("a", 3, 2.0), ("a", 7, 3.0), (None, 3, 4.0), ("b", 1, 5.0)])
    got = sorted((tuple(r) for r in adjust.forward_asof(events, bars, ["symbol"]).collect()), key=repr)
    assert got == sorted([("a", 1, 2, 1.0), ("a", 1, 2, 1.0), ("a", 2, 2, None), ("a", 3, 6, 2.0), (None, 3, 3, 4.0)], key=repr)


def test_total_return_windows_hold_times(spark):
    ways = below_windows(QUERIES["total_return_splits_lineitem"](spark, SF)) + below_windows(QUERIES["total_return_lineitem"](spark, SF))
    assert len(ways) >= 5 and all("Aggregate" in w for w in ways)


def test_total_return_of_dividends_of_one_time(spark):
    bars = spark.createDataFrame([("a", t, 100.0) for t in (0, 2, 4)], "symbol string, ts long, close double")
    dividends, splits = dated(spark, [("a", 1, 4.0), ("a", 1, 6.0), ("a", 3, 1.0), ("a", 9, 50.0)]), dated(spark, [("a", 3, 2.0), ("a", 4, 5.0)])
    got = [round(r.tr_close, 9) for r in adjust.total_return(bars, dividends, ["symbol"], splits).orderBy("ts").collect()]
    assert got == [100.0, 101.0, round(101.0 * 1.002, 9)]


def test_feeds_are_compared_on_bars_made_once(spark):
    """Sums of floats made twice may differ in their last digits, which would count as a difference of the feeds."""
    files = QUERIES["feed_columns_orders"](spark, SF).inputFiles()
    assert files and not any("orders.parquet" in f for f in files)
