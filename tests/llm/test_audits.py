"""License scans, filter audits and resampling against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest

from barque.llm import filters, importance, licenses

COLUMNS = "doc_id long, text string, source string, n long, k1 long, words string, mask string, part string, label string, score double, template int"
CLASH = (1, 2, "w", "m", "p", "l", 0.5, 3)
AZ = {c: c + 32 for c in range(65, 91)}


def table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], COLUMNS).repartition(3)


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


# ---- license scans ---------------------------------------------------------------------------------------------------

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"


def licensed():
    rng = random.Random(3)
    words = "the mit license under apache version 2 cc by nc é ß 4 0".split()
    texts = [None, "", "cc by", "CC-BY_NC cc by nc", "Under the MIT license. under the mit LICENSE", "under the mit é license", "under the Kit license", "Apache License, Version 2.0" * 300]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    texts.append(NOTICE)
    return [*((i, t, None) for i, t in enumerate(texts)), (4, texts[4], None), (None, texts[4], None), (5, "another text cc by nc", None)]


def places(text):
    words = letters(text)
    found = []
    for label, phrase in (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")):
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(i for i, _ in found), sorted({x for _, x in found})


def test_licenses(spark):
    rows = licensed()
    got = licenses.scan(table(spark, rows)).collect()
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.n_words, r.base_starts, r.base_labels) for r in got), key=key) == sorted(((i, *places(t)) for i, t, _ in rows), key=key)
    assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 and (r.score == 1 or not r.base_labels) for r in got)
    empty = licenses.scan(table(spark, rows).limit(0))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "base_starts", "base_labels", "labels", "score", "spans"]


@pytest.mark.parametrize("edit", ["none", "drop", "add", "change"])
def test_edited_notices_are_spans_of_merged_diagonals(spark, edit):
    words = letters(NOTICE)
    if edit == "drop":
        del words[20]
    if edit == "add":
        words.insert(20, "very")
    if edit == "change":
        words[20] = "odd"
    text = "some words before " + " ".join(words) + " and after it"
    (r,) = licenses.scan(table(spark, [(1, text, None)])).collect()
    (span,) = r.spans
    assert (r.labels, span.start, span.end) == (["mit"], 3, 3 + len(words)) and r.base_labels == []
    assert span.share == r.score and (r.score == 1) == (edit in ("none",)) and r.score > 0.9


def test_half_a_notice_is_none(spark):
    words = letters(NOTICE)
    rows = licenses.scan(table(spark, [(1, " ".join(words[: len(words) // 2]), None), (2, "all rights are reserved", None)])).collect()
    assert [(r.labels, r.score, r.spans) for r in rows] == [([], 0.0, [])] * 2


def test_templates_of_fewer_words_are_refused(spark):
    with pytest.raises(ValueError, match="fewer than 3"):
        licenses.scan(table(spark, []), (licenses.Template("x", "two words"),))


def test_many_templates_join_by_shuffles(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_RUNS", 0)
    (r,) = licenses.scan(table(spark, [(1, NOTICE, None)])).collect()
    assert r.labels == ["mit"]


# ---- filter audits ---------------------------------------------------------------------------------------------------


def audited(spark):
    rng = random.Random(4)
    pool = ["Aa", "b", "c#", "é", "D", "x y", "ee\vff", " "] + [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n", "A" * 50, "# #", "one two " * 300]
    texts += [" ".join(rng.choice(pool[: rng.choice([3, 8, 308])]) for _ in range(rng.choice([5, 150, 199, 200, 201, 600]))) for _ in range(60)]
    rows = [(i, t, rng.choice([None, "", "a", "b"])) for i, t in enumerate(texts)]
    rows += [(100 + i, rng.choice(texts), rng.choice(["a", "c"])) for i in range(60)]
    rows += [rows[70], (70, rows[71][1], "a"), (None, texts[20], "a"), (None, texts[20], "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)] + [(2, 1, 1), (None, 1, 1)]
    return rows, labels


def audit(rows, labels):
    """One order after the other."""
    least, good, toxic = {}, set(), set()
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, quality, bad in labels:
        good |= {i} if quality == 1 and i is not None else set()
        toxic |= {i} if bad == 1 and i is not None else set()

    def fails(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        return {x for x, failed in out.items() if failed}

    parts = collections.defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append((i, fails(i, t)))
    out, shapley = [], collections.Counter()
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                failing = [d for d in docs if x in d[1]]
                shapley[part, x] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(d[1] == {x} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit(spark):
    rows, labels = audited(spark)
    of_labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filters.filter_audit(table(spark, rows), of_labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == audit(rows, labels)
    assert filters.filter_audit(table(spark, rows).limit(0), of_labels).collect() == []
    none = filters.filter_audit(table(spark, rows), of_labels.limit(0)).filter("good_lost + toxic_lost > 0")
    assert none.isEmpty()


def test_other_filters(spark):
    rows = table(spark, [(1, "a b", "x"), (2, "c", "x"), (3, None, "x")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filters.filter_audit(rows, labels, {"S": "size(words) < 2", "T": "text = 'a b'"})
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.shapley) for r in got.collect()) == [("ST", 1, 1, 2, 4), ("ST", 2, 0, 1, 2), ("TS", 1, 2, 1, 2), ("TS", 2, 0, 2, 4)]
    with pytest.raises(ValueError, match="filters"):
        filters.filter_audit(rows, labels, dict.fromkeys("ABCDEFG", "true"))


# ---- importance resampling -------------------------------------------------------------------------------------------


def resampled(rows, target, percent=10, least=20, buckets=10_000, longest=1):
    def features(text):
        w = letters(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(at(f) for r in rows for f in features(r[1]))
    t = collections.Counter(at(f) for x in target for f in features(x))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text, _ in rows:
        f = features(text)
        weight = sum(gain(at(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(letters(text)) >= least))
    n = sum(r[4] for r in out) * percent // 100
    best = sorted((r for r in out if r[4] and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))[:n]
    drawn = collections.defaultdict(list)
    for rank, r in enumerate(best, 1):
        drawn[r].append(rank)
    return sorted((*r[:4], drawn[r].pop(0) if drawn[r] else 0) for r in sorted(out, key=repr) if r[0] is not None) + sorted((*r[1:4], 0) for r in out if r[0] is None)


def drawable():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)] + ["É", "é", "K", "İx", "Abc"]
    texts = [None, "", "one", "w1 " * 5000] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(300)]
    rows = [(i, t, None) for i, t in enumerate(texts)]
    rows += [rows[40]] * 30 + [(41, rows[42][1], None), (None, rows[42][1], None)]
    return rows, [None, "", "w1 w2 w3 É " * 30, "w5 w6"]


@pytest.mark.parametrize("percent, longest", [(10, 1), (100, 1), (0, 1), (37, 2)])
def test_resample(spark, percent, longest):
    rows, target = drawable()
    of_target = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(table(spark, rows), of_target, percent=percent, longest=longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"] or 0) for r in got.collect()]
    assert sorted(r for r in got if r[0] is not None) + sorted(r[1:] for r in got if r[0] is None) == resampled(rows, target, percent, longest=longest)


def test_resample_of_nothing(spark):
    of_target = spark.createDataFrame([], "text string")
    rows = table(spark, drawable()[0])
    assert importance.resample(rows.limit(0), of_target).collect() == []
    assert sum(r["rank"] is not None for r in importance.resample(rows, of_target).collect()) == sum(len(letters(t)) >= 20 for _, t, _ in drawable()[0]) // 10


@pytest.mark.parametrize("spread", [3, 10**6])
def test_kth_key_equals_sorting(spark, spread):
    rng = random.Random(8)
    keys = [(rng.randint(-spread, spread), rng.randint(0, 500)) for _ in range(700)]
    by = spark.createDataFrame(keys, "score long, id long").repartition(7)
    order = sorted(keys, key=lambda x: (-x[0], x[1]))
    for k in (1, 2, 350, 699, 700):
        assert importance.kth_key(by, k) == order[k - 1]
