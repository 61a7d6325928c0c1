"""Exact repeated passages by suffix order and longest previous factors (operator 1).

A byte goes when a `length`-byte string that covers it also starts elsewhere. No pair of documents is ever formed:

1.  Every window of `length` bytes has an anchor, a k-gram picked by hash (see rolling.anchors), so that equal windows
    have equal anchors at equal distances. One row stands for the run of windows that share an anchor: about one row
    for 85 bytes. Runs whose k-gram occurs once hold no repeat.
2.  Runs that are equal as a whole (same bytes, same distances) form classes. In a class of two or more, all are
    repeats of its first member. What belongs to a hot class is found in the order of the documents, and spans that
    follow one another there become one.
3.  One member of each class, and the runs equal to no other, are compared byte by byte: their windows are put in
    suffix order (prefix doubling), and previous and next smaller places in that order tell whether a window occurs
    earlier; the same arrays of larger places tell whether it occurs later.
    Groups of one k-gram over `group_limit` runs are first cut into quarters with longer keys, again and again, at last
    into single windows, where steps 1 and 2 alone decide. A run that leaves a passage common to many keeps one piece
    undecided in each round, so its pieces stay few. No group of unbounded size meets in a task.

Copies of a whole text are told by its hashes before all this, and one of them stands for the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barque.llm.rolling import Rolling, anchors
from barque.llm.storage import discard, stored
from barque.llm.streams import whole_groups

GRAM = 32
GROUP_LIMIT = 256
CHUNK = 1 << 18
RUN = "id long, k1 long, p int, lo int, hi int, key long, class long"


# ---- suffix order inside one bounded batch -------------------------------------------------------------------------


def suffix_classes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `starts` by their first `length` bytes, and the class (equal bytes) of each, in that
    order. data has at least `length` bytes after each start. Prefix doubling, first over 8 bytes."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.zeros(n, np.uint64)
    for j in range(min(8, length)):
        word = (word << np.uint64(8)) | padded[j : j + n].astype(np.uint64)
    rank, size = np.unique(word, return_inverse=True)[1].astype(np.int64), min(8, length)
    while size < length:
        step = min(size, length - size)
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64)
        size += step
    own = rank[starts]
    order = np.argsort(own, kind="stable")
    return order, own[order]


def nearest_smaller(place: np.ndarray) -> np.ndarray:
    """For each entry the index of the last one before it with a smaller place, else -1 (by pointer jumping). Equal
    places are one place met twice and don't count."""
    at = np.arange(-1, len(place) - 1)
    active = np.flatnonzero(at >= 0)
    while len(active):
        active = active[place[at[active]] >= place[active]]
        at[active] = at[at[active]]
        active = active[at[active] >= 0]
    return at


def previous_factor(classes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which suffixes, given in suffix order, have an earlier place among those with the same first bytes: their
    longest previous factor, found at the previous or the next smaller place in suffix order, is long enough."""
    before = nearest_smaller(place)
    after = len(place) - 1 - nearest_smaller(place[::-1])[::-1]
    found = np.zeros(len(place), bool)
    has = before >= 0
    found[has] = classes[before[has]] == classes[has]
    has = after < len(place)
    found[has] |= classes[after[has]] == classes[has]
    return found


# ---- tasks -----------------------------------------------------------------------------------------------------------


def _runs(length: int, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, k1 = batch.column("id"), batch.column("k1")
            rows, parts, held = [], [], 0
            for i, data in enumerate(batch.column("data")):
                data = data.as_py()
                if len(data) < length:
                    continue
                roll = Rolling(data)
                p, lo, hi, gram = anchors(roll, length, k)
                parts.append((p, lo, hi, gram.view(np.int64), _with(roll.spans(lo, hi + length), p - lo, hi - p)))
                rows.append(np.full(len(p), i))
                held += len(p)
                if held > 100_000:
                    yield _run_batch(ids, k1, rows, parts)
                    rows, parts, held = [], [], 0
            if rows:
                yield _run_batch(ids, k1, rows, parts)

    return task


def _with(h: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    shape = (before.astype(np.uint64) << np.uint64(20)) + (after + 1_000_000).astype(np.uint64)
    return (h ^ (shape * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def _run_batch(ids, k1, rows, parts) -> pa.RecordBatch:
    at = pa.array(np.concatenate(rows))
    p, lo, hi, gram, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
    columns = [ids.take(at), k1.take(at), *(pa.array(x.astype(np.int32)) for x in (p, lo, hi)), pa.array(gram), pa.array(whole)]
    return pa.RecordBatch.from_arrays(columns, ["id", "k1", "p", "lo", "hi", "key", "class"])


def _compared(table: pa.Table, length: int, earlier_only: bool) -> pa.RecordBatch:
    """From runs with their bytes to the spans of their windows that repeat."""
    lo = table.column("lo").to_numpy()
    hi = table.column("hi").to_numpy()
    rows = np.arange(len(lo))
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    base = np.concatenate(([0], np.cumsum(hi - lo + length)))[:-1].astype(np.int64)
    n_windows = (hi - lo + 1).astype(np.int64)
    row = np.repeat(rows, n_windows)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    order, classes = suffix_classes(data, base[row] + inner, length)
    ids, k1 = table.column("id").to_numpy(), table.column("k1").to_numpy()
    by_place = np.lexsort((lo, k1, ids))
    new = np.ones(len(rows), bool)
    new[1:] = np.any([x[by_place][1:] != x[by_place][:-1] for x in (ids, k1, lo)], axis=0)
    row_rank = np.empty(len(lo), np.int64)
    row_rank[by_place] = np.cumsum(new)
    place = (row_rank[row] * (int(n_windows.max(initial=0)) + 1) + inner)[order]
    repeats = previous_factor(classes, place)
    if not earlier_only:
        repeats |= previous_factor(classes, -place)
    mask = np.zeros(len(row), bool)
    mask[order[repeats]] = True
    hit = np.flatnonzero(mask)
    fresh = np.ones(len(hit), bool)  # begins a span: another run, or not the next window
    fresh[1:] = (np.diff(hit) > 1) | (row[hit][1:] != row[hit][:-1])
    last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(hit) - 1])) if len(hit) else hit
    starts, ends = hit[fresh], hit[last]
    r = row[starts]
    columns = [ids[r], k1[r], (lo[r] + inner[starts]).astype(np.int32), (lo[r] + inner[ends] + length).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "k1", "s", "e"])


def _compare(length: int, earlier_only: bool):
    """Rows come sorted by key. Whole groups of one key are compared, about CHUNK bytes at a time, whatever the size of
    the partition."""

    def size(table: pa.Table) -> np.ndarray:
        return np.cumsum(table.column("hi").to_numpy() - table.column("lo").to_numpy() + length)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", size, CHUNK):
            yield _compared(table, length, earlier_only)

    return task


def merge_spans(spans: list, n: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, min(e, n)) for s, e in out]


# ---- the operator ----------------------------------------------------------------------------------------------------


HOT_CLASSES = 10_000  # that a task looks up, at most
HOT_LEAST = 64  # members of a hot class


def _merged(hot: pa.Table, earlier_only: bool):
    """Spans of windows of hot classes. Rows stand in the order of their documents, so windows that follow one another are
    one span before anything is shuffled."""
    hot = hot.sort_by("class")
    known, keys = hot.column("class").to_numpy(), hot.column("key").to_numpy()
    firsts = [hot.column(c).to_numpy() for c in ("id", "k1", "lo")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, k1, lo, hi, key, own = (batch.column(c).to_numpy() for c in ("id", "k1", "lo", "hi", "key", "class"))
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            found = (known[at] == own) & (keys[at] == key)
            if earlier_only:
                found &= np.any([x != y[at] for x, y in zip((ids, k1, lo), firsts, strict=True)], axis=0)
            r = np.flatnonzero(found)
            fresh = np.ones(len(r), bool)
            fresh[1:] = (np.diff(r) > 1) | (ids[r][1:] != ids[r][:-1]) | (k1[r][1:] != k1[r][:-1]) | (lo[r][1:] != hi[r][:-1] + 1)
            starts, ends = r[fresh], r[np.append(fresh[1:], True)] if len(r) else r
            yield pa.RecordBatch.from_arrays([pa.array(ids[starts]), pa.array(k1[starts]), pa.array(lo[starts].astype(np.int32)), pa.array(hi[ends].astype(np.int32))], ["id", "k1", "s", "e"])

    return task


def _resolve(runs: DataFrame, in_order: DataFrame, earlier_only: bool) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Runs, split into spans (last window for end) that surely repeat and runs still to compare; and the tables to discard
    in the end.

    The first of each class stays to compare if its key has another class; the rest of the class repeats it. Members of hot
    classes are told where they stand, in_order, and merged by document; of those there can't be more than HOT_CLASSES, as
    each has more than its share of the runs. Members of the others meet their class in a join.
    """
    me = F.struct("id", "k1", "p", "lo", "hi")
    classes = stored(runs.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("first")), "classes")
    keys = classes.groupBy("key").agg(F.count(F.lit(1)).alias("group"), F.min("n").alias("least"))
    several = (F.col("group") > 1) if earlier_only else (F.col("group") > 1) & (F.col("least") == 1)
    keys = stored(keys.filter(several).select("key", "group"), "keys")
    todo = classes.join(keys, "key").select("first.*", "key", "group")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(HOT_LEAST, total // HOT_CLASSES)
    hot = classes.filter(F.col("n") > most).select("key", "class", "first.id", "first.k1", "first.lo")
    at_once = hot.toArrow()
    met = classes.filter((F.col("n") > 1) & (F.col("n") <= most)).select("key", "class", "first")
    rest = runs
    if at_once.num_rows:
        rest = runs.join(F.broadcast(hot.select("key", "class")), ["key", "class"], "left_anti")
    sure = rest.join(met, ["key", "class"])
    if earlier_only:
        sure = sure.filter(me != F.col("first"))
    sure = sure.select("id", "k1", F.col("lo").cast("int").alias("s"), F.col("hi").cast("int").alias("e"))
    if at_once.num_rows:
        columns = in_order.select("id", "k1", "lo", "hi", "key", "class")
        sure = sure.unionByName(columns.mapInArrow(_merged(at_once, earlier_only), "id long, k1 long, s int, e int"))
    return sure, todo, [classes, keys]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Columns id, k1, k2 that name a text: its document and two hashes. A null id becomes one before all others, of the
    text itself, so that texts under null ids don't meet."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    k2 = F.xxhash64(F.lit(1), text)
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)) + F.pmod(k2, F.lit(1 << 40))).alias("id"), F.xxhash64(text).alias("k1"), k2.alias("k2")]


def repeated_spans(docs: DataFrame, length: int = 200, earlier_only: bool = False, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Spans of `docs` (id, k1 and k2 of `keyed`, data binary) whose windows of `length` bytes occur elsewhere too.

    earlier_only: only windows that occur before, in the order of id, then of k1, then of place. Rows: id, k1, s, e;
    spans of one document may overlap. Copies of a whole text are found by its hashes; one of them stands for all from
    there on. Rows equal in id and text are copies, but with earlier_only one document, which the other rows don't cut.
    """
    texts = stored(docs.groupBy("id", "k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("data")).alias("size")), "texts")
    copied = stored(texts.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n"), "copied")
    of_copies = texts.filter(F.col("size") >= length).join(copied, ["k1", "k2"])
    if earlier_only:
        of_copies = of_copies.filter("id > first")
    spans = [of_copies.select("id", "k1", F.lit(0).alias("s"), F.col("size").alias("e"))]

    k = min(GRAM, length)
    shift = length - k  # a window's anchor stands 0 to shift bytes after its start
    every = stored(docs.select("id", "k1", "data").mapInArrow(_runs(length, k), RUN), "runs")
    # of two texts, or at two places of one
    twice = every.groupBy("key").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("p").alias("c"), F.max("p").alias("d"))
    twice = stored(twice.filter("a < b or c < d").select("key"), "twice")
    # grouped without the key, so that Spark sums up copies before it deals them anew, and may split a hot key in the join
    once = every.join(twice, "key", "left_semi").groupBy("k1", "p", "lo", "hi").agg(F.min("key").alias("key"), F.min("class").alias("class"), F.min("id").alias("id"))
    runs = stored(once, "repeated_runs")
    discard(twice)
    sure, todo, gone = _resolve(runs, every, earlier_only)
    spans.append(sure.withColumn("e", F.col("e") + length))
    gone += [texts, copied, every, runs]

    wanted = todo.groupBy("id", "k1").agg(F.collect_list(F.struct("p", "lo", "hi", "key", "group")).alias("wanted"))
    rows = docs.select("id", "k1", "data")
    if not texts.filter("n > 1").isEmpty():
        rows = rows.dropDuplicates(["id", "k1"])
    found = wanted.join(rows, ["id", "k1"]).select("id", "k1", "data", F.explode("wanted").alias("r"))
    todo = stored(found.select("id", "k1", "r.*", F.expr(f"substring(data, r.lo + 1, r.hi - r.lo + {length})").alias("bytes")), "compare")
    gone.append(todo)

    small = todo.filter(F.col("group") <= group_limit)
    large, width = todo.filter(F.col("group") > group_limit), shift + 1
    while not large.isEmpty():
        width = -(-width // 4)  # pieces of a quarter, down to single windows, where equal bytes alone decide
        first = f"(p - {shift} + j * {width})"  # of the windows of piece j, as far from the anchor in each document
        last = f"least(p, {first} + {width - 1})"
        pieces = large.withColumn("j", F.explode(F.expr(f"sequence((lo - p + {shift}) div {width}, (hi - p + {shift}) div {width})")))
        pieces = pieces.select("*", F.expr(f"greatest(lo, {first})").alias("a"), F.expr(f"least(hi, {last})").alias("b"))
        common = F.expr(f"substring(bytes, {last} - lo + 1, {first} + {length} - {last})")  # in all windows of the piece
        whole = F.expr(f"substring(bytes, a - lo + 1, b - a + {length})")
        pieces = pieces.select("id", "k1", "p", "a", "b", F.xxhash64("key", "j", common).alias("k"), F.xxhash64("key", "j", F.expr("a - p"), F.expr("b - p"), whole).alias("class"), whole.alias("bytes"))
        pieces = stored(pieces.withColumnsRenamed({"a": "lo", "b": "hi", "k": "key"}), "pieces")
        sure, rest, more = _resolve(pieces.drop("bytes"), pieces, earlier_only)
        spans.append(sure.withColumn("e", F.col("e") + length))
        gone += [pieces, *more]
        if width == 1:
            break
        rest = stored(rest.join(pieces.select("id", "k1", "p", "lo", "bytes"), ["id", "k1", "p", "lo"]), "compare")
        gone.append(rest)
        small = small.unionByName(rest.filter(F.col("group") <= group_limit))
        large = rest.filter(F.col("group") > group_limit)
    compare = small.select("key", "id", "k1", "lo", "hi", "bytes").repartition("key").sortWithinPartitions("key")
    out = compare.mapInArrow(_compare(length, earlier_only), "id long, k1 long, s int, e int")
    for x in spans:
        out = out.unionByName(x)
    out = stored(out, "spans")
    discard(*gone)
    return out


def remove_repeats(docs: DataFrame, length: int = 200, keep: str = "none", id_col: str = "doc_id", text_col: str = "text", group_limit: int = GROUP_LIMIT, whole_characters: bool = False) -> DataFrame:
    """Cut repeated passages of at least `length` bytes out of whole texts.

    keep="none" removes every copy, "first" all but the first (by id, then place). Returns doc_id, k1 (hash of the
    text), n_bytes, n_removed, n_spans, kept_sha256, kept (binary), spans (array of [s, e)).
    whole_characters: spans shrink to whole UTF-8 characters, so that kept stays valid text.
    A null text counts as empty; texts under `length` bytes, empty ones and empty tables lose nothing; rows that are
    repeated are copies of each other; a null id stands before all others; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keyed(docs, id_col, text_col), F.encode(text, "UTF-8").alias("data"))
    spans = repeated_spans(rows.drop("doc_id"), length, keep == "first", group_limit)
    spans = spans.groupBy("id", "k1").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = rows.join(spans, ["id", "k1"], "left").select("doc_id", "k1", "data", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, found in zip(batch.column("data"), batch.column("spans"), strict=True):
                data = data.as_py()
                spans = merge_spans([(x["s"], x["e"]) for x in found.as_py() or []], len(data))
                if whole_characters:
                    spans = [x for x in (_whole(data, *x) for x in spans) if x[0] < x[1]]
                kept = data
                if spans:
                    at = [0, *(y for x in spans for y in x), len(data)]
                    kept = b"".join(data[at[i] : at[i + 1]] for i in range(0, len(at), 2))
                out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, [{"s": s, "e": e} for s, e in spans]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k1"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "k1", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return joined.mapInArrow(cut, "doc_id long, k1 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<s:int,e:int>>")


def _whole(data: bytes, s: int, e: int) -> tuple[int, int]:
    while s < e and data[s] & 0xC0 == 0x80:
        s += 1
    while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
        e -= 1
    return s, e


def cut_text():
    """Column function (text, spans of bytes) to the text without the spans, in whole characters."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            data = (text or "").encode()
            at = [0]
            for s, e in merge_spans([(x["s"], x["e"]) for x in (found if found is not None else ())], len(data)):
                s, e = _whole(data, s, e)
                at += [s, max(s, e)]
            at.append(len(data))
            out.append(b"".join(data[at[i] : at[i + 1]] for i in range(0, len(at), 2)).decode())
        return pd.Series(out)

    return cut


def op1_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
