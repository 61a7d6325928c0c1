"""Hand cases of the cleaning rules, and every query against its SQL at the smallest scale."""

import math

import duckdb
import pytest

from barque.functions import sessions
from barque.operators import adjust, checks, clean, features, publication, registry
from barque.sources import chunks
from barque.plans.catalog import QUERIES, SQL, load

load()

SF = "/root/testdata/sf0.001"
HOUR = sessions.HOUR
START = 1420416000000  # Monday 2015-01-05
RULE = clean.Thresholds(HOUR, 0.2, 1, 3, 10)


def bars(spark, n=60, closes=None, volumes=None, skip=(), opens=None):
    closes = closes or [100 + (i % 7) * 0.5 for i in range(n)]
    rows = []
    for i in range(n):
        if i not in skip:
            o = opens[i] if opens else (closes[i - 1] if i else closes[0])
            rows.append(("X", START + i * HOUR, o, max(o, closes[i]) + 1, min(o, closes[i]) - 1, closes[i], float(volumes[i]) if volumes else 10.0, 1000.0, i))
    return spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume double, amount double, row long")


def cut(spark, df, rule=RULE):
    return sorted((r.start_ts, r.n_bars, r.start_reason, r.end_reason) for r in clean.segments(df, ["symbol"], rule).collect())


def test_one_clean_series(spark):
    assert cut(spark, bars(spark)) == [(START, 60, "series_start", "series_end")]


def test_gap_and_jump(spark):
    assert [x[1:] for x in cut(spark, bars(spark, skip={30}))] == [(30, "series_start", "gap"), (29, "gap", "series_end")]
    closes = [100 + (i % 7) * 0.5 for i in range(30)] + [25 + (i % 7) * 0.1 for i in range(30)]
    opens = [closes[0], *closes[:29], 25.0, *closes[30:59]]
    assert [x[1:] for x in cut(spark, bars(spark, closes=closes, opens=opens))] == [(30, "series_start", "jump"), (30, "jump", "series_end")]


@pytest.mark.parametrize(("run", "pieces"), [(1, 1), (2, 2)])
def test_illiquid_runs_at_the_limit(spark, run, pieces):
    volumes = [0 if 30 <= i < 30 + run else 5 for i in range(60)]
    assert len(cut(spark, bars(spark, volumes=volumes))) == pieces


@pytest.mark.parametrize(("run", "pieces"), [(3, 1), (4, 2)])
def test_stagnant_runs_at_the_limit(spark, run, pieces):
    closes = [100 + (i % 7) * 0.5 for i in range(60)]
    closes[30 : 30 + run] = [200 / 2 + 0.25] * run
    assert len(cut(spark, bars(spark, closes=closes))) == pieces


def test_weekend_slots_equal_enumeration():
    prefix = sessions.open_prefix("weekend", HOUR)
    assert prefix[-1] == 168 - 24 - 4 - 23
    week = [(i // 24 + 3) % 7 for i in range(168)]
    assert all((prefix[i + 1] - prefix[i] == 1) == (week[i] not in (4, 5, 6) or (week[i] == 4 and i % 24 < 20) or (week[i] == 6 and i % 24 >= 23)) for i in range(168))


def test_refusals(spark):
    bad = bars(spark, n=3).union(bars(spark, n=1).selectExpr("'Y' symbol", *[c for c in bars(spark, n=1).columns if c != "symbol"]))
    assert [(r.symbol, r.code) for r in features.refusals(bad, ["symbol"]).collect()] == [("Y", "too_short")]


def test_dividends(spark):
    b = bars(spark, n=5, closes=[100.0, 100.0, 100.0, 100.0, 100.0])
    d = spark.createDataFrame([("X", START + HOUR + 1, 1.0), ("X", START + 9 * HOUR, 5.0)], "symbol string, ts long, value double")
    got = [r.tr_close for r in adjust.total_return(b, d, ["symbol"]).orderBy("ts").collect()]
    assert all(math.isclose(a, e) for a, e in zip(got, [100, 100, 101, 101, 101], strict=True))


def test_content_hash_ignores_order(spark):
    b = bars(spark, n=20)
    one, two = (registry.content_hash(x).first()[0] for x in (b, b.repartition(3).orderBy("close")))
    assert one == two != registry.content_hash(b.filter("row > 0")).first()[0]


def test_crypto_candidates(spark):
    rows = spark.createDataFrame([(s,) for s in ("BTCUSDT", "BTCUPUSDT", "JUPUSDT", "USDCUSDT", "BTCEUR")], "symbol string")
    assert {r.symbol for r in registry.candidates(rows, "USDT", ["USDC"]).collect()} == {"BTCUSDT", "JUPUSDT"}


def test_live_features_equal_batch(spark):
    a = {(r.symbol, r.ts): r for r in QUERIES["live_features_events"](spark, SF).collect()}
    b = QUERIES["features_events"](spark, SF).collect()
    names = ("gap", "body", "upper", "lower", "rel_volume", "rel_amount")
    assert len(a) == len(b) and all(math.isclose(a[r.symbol, r.ts][c], r[c], abs_tol=2e-6) for r in b for c in names)


def test_rules_must_be_verified(spark):
    rules = spark.createDataFrame([("1h", True, 256), ("5m", False, 256)], "frequency string, verified boolean, min_bars int")
    rows = lambda f: spark.createDataFrame([(f, 1)], "frequency string, x int")
    assert checks.with_rules(rows("1h"), rules, ["frequency"]).first().min_bars == 256
    for f in ("5m", "1w"):
        with pytest.raises(Exception, match="no verified thresholds"):
            checks.with_rules(rows(f), rules, ["frequency"]).collect()


def test_red_flags_ignore_closed_sessions(spark):
    rows = [("s", "SPY", r, 100, 90, n, c) for r, n, c in (("session_filter", 10, 0), ("gap", 0, 400), ("stagnant", 0, 0))]
    stats = spark.createDataFrame(rows, "source string, symbol string, rule string, total_bars long, kept_bars long, bars_dropped long, cuts long")
    assert [(r.check, r.value) for r in checks.red_flags(stats, ["source", "symbol"], ["source"]).collect()] == [("weekend_cut_as_gap", 400.0)]


@pytest.mark.parametrize(("verdicts", "medians", "policy"), [(["inconclusive"], [0.0], "unknown"), (["adjusted", "unadjusted"], [0.0], "unadjusted"), (["adjusted"], [], "split"), (["adjusted"], [0.01, 0.02, 0.03, 0.01], "split+dividend"), (["adjusted"], [0.01, 0.03], "split")])
def test_adjustment_class(spark, verdicts, medians, policy):
    probes = spark.createDataFrame([("s", v) for v in verdicts], "source string, verdict string")
    compared = spark.createDataFrame([("s", "compared", m) for m in medians], "source string, status string, median_diff double")
    assert checks.adjustment_class(probes, compared, ["source"]).first().policy == policy


def test_spec_comparison(spark):
    rows = [("a", f, 10, 1, -1.0, 1.0) for f in checks.GEO] + [("a", f, 10, 0, -2.0, 2.0) for f in checks.RET] + [("b", "gap", 1, 0, 0.0, 1.0)]
    table = spark.createDataFrame(rows, "cls string, feature string, n long, clipped long, q01 double, q99 double")
    assert [tuple(r) for r in checks.spec_comparison(table, ["cls"]).collect()] == [("a", 10.0, 2.0, 0.0, 4.0)]


def test_partial_runs_dont_replace_the_full_index(spark, tmp_path):
    path, rows = str(tmp_path / "index"), spark.createDataFrame([("s", 1)], "segment_id string, n_bars long")
    publication.write_index(spark, rows, path, partial=False)
    with pytest.raises(ValueError, match="partial"):
        publication.write_index(spark, rows, path, partial=True)
    publication.write_index(spark, rows, path, partial=True, forced=True)
    publication.write_index(spark, rows, path, partial=True)
    assert spark.read.parquet(path).first().partial


def test_total_return_only_where_accumulated(spark):
    b = bars(spark, n=3, closes=[100.0, 100.0, 100.0])
    b = b.union(b.selectExpr("'Y' symbol", *[c for c in b.columns if c != "symbol"]))
    d = spark.createDataFrame([("X", START + HOUR, 1.0)], "symbol string, ts long, value double")
    v = spark.createDataFrame([("X", "accumulate"), ("Y", "skip")], "symbol string, verdict string")
    tier, coverage = checks.total_return_tier(b, d, v, ["symbol"])
    assert {r.symbol for r in tier.collect()} == {"X"}
    assert {(r.symbol, r.bars, r.dividends, r.derived) for r in coverage.collect()} == {("X", 3, 1, True), ("Y", 3, 0, False)}


def test_archive_members(spark):
    rows = [("d/us/nasdaq stocks/1/a.us.txt", 30), ("d/us/nyse etfs/b.us.TXT", 29), ("d/us/stocks/x.csv", 50), ("d/pl/stocks/x.txt", 50), ("d/us/indices/x.txt", 50), (None, 50)]
    got = [r.status for r in chunks.member_class(spark.createDataFrame(rows, "path string, n_lines long")).collect()]
    assert got == ["keep", "too_short", "not_text", "not_us", "not_equity", "not_text"]


@pytest.mark.parametrize("name", ["forward_asof_lineitem", "split_factor_lineitem"])
def test_events_of_every_row(spark, name):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    got = QUERIES[name](spark, SF)
    assert got.count() == rows if name.startswith("split") else rows * 0.98 < got.count() <= rows
    assert all(math.isfinite(x[0]) for x in got.select(got.columns[-1]).distinct().collect())


def test_segment_bars_end_before_the_firewall(spark):
    df = bars(spark, skip={30})
    segs = clean.segments(df, ["symbol"], RULE)
    by = lambda x: sorted((r.segment_id, r["count"]) for r in x.groupBy("segment_id").count().collect())
    assert by(clean.segment_bars(df, segs, ["symbol"])) == [(f"X:{START}", 30), (f"X:{START + 31 * HOUR}", 29)]
    assert by(clean.segment_bars(df, segs, ["symbol"], START + 33 * HOUR)) == [(f"X:{START}", 30), (f"X:{START + 31 * HOUR}", 2)]


def test_constants_of_segments(spark):
    got = QUERIES["fit_constants_segments_events"](spark, "/root/testdata/sf0.01").collect()  # no segments at the smallest scale
    assert sorted(r.feature for r in got) == sorted(r.feature for r in QUERIES["fit_constants_events"](spark, SF).collect())


def test_history_counts_and_config(spark):
    r = spark.createDataFrame([("a", 730.5), ("b", 730.4), ("c", None)], "symbol string, history_days double")
    assert [x.symbol for x in registry.with_history(r, 2).collect()] == ["a"]
    v = spark.createDataFrame([(x,) for x in (10, 9, 9, 10, 2, None)], "v int")
    assert [tuple(x) for x in registry.top_counts(v, "v", 2).collect()] == [(10, 2), (9, 2)]
    index = spark.createDataFrame([("a", "h"), ("b", "h")], "artifact string, clean_config_hash string")
    assert registry.of_config(index, "h").select("artifact").count() == 2
    for other in ("i", None):
        with pytest.raises(Exception, match="another configuration"):
            registry.of_config(index.union(spark.createDataFrame([("c", other)], index.schema)), "h").select("artifact").collect()


def norm(v):
    return round(float(v), 9) + 0.0 if isinstance(v, float) or hasattr(v, "is_finite") else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = con.execute(SQL[name])
    names = [x[0] for x in r.description]
    want = sorted((tuple(norm(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert sorted(names) == cols and got == want
