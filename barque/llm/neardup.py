"""Near duplicates by MinHash bands and sequential Bayesian verification (operator 2).

1.  One pass gives each document's shingle set size, a 128-bit hash of the set and a MinHash signature. Documents with
    equal sets are one class, whatever their number; one id stands for it from here on.
2.  Signatures are cut into bands; classes that share a band's hash are candidates. Each class is first compared with
    the smallest id of all its buckets (one pair a class), then, where they are still apart, with the smallest ids of
    its other buckets; never all pairs.
3.  Candidates are pruned batch by batch of signature values: a pair goes as soon as the posterior probability that
    its similarity reaches the threshold, given the matches so far, falls under `miss`. Survivors are confirmed on
    their full sets.
4.  Buckets that still hold several components are compared in full, across components only, in blocks of bounded
    size: first by signatures, which leaves the members that have a survivor, then those on their full sets in the
    task; only members and links leave a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barque.llm.components import components
from barque.llm.storage import discard, stored
from barque.llm.streams import whole_groups
from barque.llm.words import shingle_set

BANDS, ROWS, BATCH, MISS = 32, 4, 16, 1e-6
LEFT, RIGHT, STAR, SENT_IDS = 256, 1024, 1000, 200_000
TABLE = 2048  # rows of blocks that are worked on at once, or one block
_RNG = np.random.default_rng(20240607)
_A = _RNG.integers(1, 1 << 32, 1024, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(1, 1 << 32, 1024, dtype=np.uint32)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of a set of 64-bit hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    low = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        y = x[i : i + 1024, None] * _A[:n] + _B[:n]
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x7FEB352D)
        y ^= y >> np.uint32(15)
        np.minimum(low, y.min(axis=0), out=low)
    return low


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Least number of equal values among n with which P(similarity >= threshold) is still `miss` or more.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its tail over the threshold is a binomial sum.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n + 1


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Indexes of the pairs of signature rows that no batch prunes."""
    left = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for at in range(0, a.shape[1], BATCH):
        matches[left] += (a[left, at : at + BATCH] == b[left, at : at + BATCH]).sum(axis=1, dtype=np.int32)
        left = left[matches[left] >= least_matches(at + BATCH, threshold, miss)]
    return left


def _sketch(words: int, n_values: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, s1, s2, sig = [], [], [], []
            for text in batch.column("data"):
                found = shingle_set(text.as_py(), words)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                size.append(len(found))
                s1.append(int.from_bytes(digest[:8], "little", signed=True))
                s2.append(int.from_bytes(digest[8:], "little", signed=True))
                sig.append(signature(found, n_values).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "s1", "s2", "sig"])

    return task


def _prune(threshold: float, miss: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).take(pa.array(survivors(a, b, threshold, miss)))

    return task


def _block_pairs(table: pa.Table, threshold: float, miss: float, rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each left row of a block, those right rows of other components that survive pruning. A pair is looked at in
    the first band on which its signatures agree."""
    block = table.column("block").to_numpy()
    order = np.argsort(block, kind="stable")
    ids, label, band = (table.column(c).to_numpy() for c in ("id", "label", "band"))
    is_left, centre = table.column("is_left").to_numpy(zero_copy_only=False), table.column("centre").to_numpy()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(ids), -1)
    for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []:
        left, right = part[is_left[part]], part[~is_left[part]]
        for x in left[ids[left] != centre[left]]:
            other = right[(label[right] != label[x]) & (ids[right] != centre[x])]
            agree = (sig[other] == sig[x]).reshape(len(other), sig.shape[1] // rows, rows).all(axis=2)
            other = other[agree.argmax(axis=1) == band[x]] if len(other) else other
            other = other[survivors(np.broadcast_to(sig[x], (len(other), sig.shape[1])), sig[other], threshold, miss)]
            if len(other):
                yield x, other


def _rows(table: pa.Table) -> np.ndarray:
    return np.arange(1, table.num_rows + 1)


def _narrow(threshold: float, miss: float, rows: int):
    """The rows of blocks that have a survivor: at most as many as came."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block", _rows, TABLE):
            keep = np.zeros(table.num_rows, bool)
            for x, other in _block_pairs(table, threshold, miss, rows):
                keep[x] = True
                keep[other] = True
            yield from table.filter(pa.array(keep)).to_batches()

    return task


def _blocks(threshold: float, miss: float, words: int, percent: int, rows: int):
    """Survivors confirmed on their full sets; only links leave the task."""

    def links(table: pa.Table) -> pa.RecordBatch:
        ids, texts = table.column("id").to_numpy(), table.column("data")
        sets, out = {}, set()

        def shingles(i: int) -> np.ndarray:
            if ids[i] not in sets:
                sets[ids[i]] = shingle_set(texts[int(i)].as_py(), words)
            return sets[ids[i]]

        for x, other in _block_pairs(table, threshold, miss, rows):
            for y in other:
                a, b = shingles(x), shingles(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    out.add((min(ids[x], ids[y]), max(ids[x], ids[y])))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64))], ["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block", _rows, TABLE):
            yield links(table)

    return task


def _confirm(words: int, percent: int):
    """Rows come sorted by (a, salt, b): first the text of a itself (b null), then those to compare with it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            found = []
            for a, b, data in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("data"), strict=True):
                shingles = shingle_set(data.as_py(), words)
                if b is None:
                    head, own = a, shingles
                    continue
                if head != a:
                    raise ValueError(f"no text of {a} before those to compare with it")
                both = len(np.intersect1d(own, shingles, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(shingles) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return task


def needed(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """texts of the given ids alone. Up to SENT_IDS ids, counted first, are sent to the scan, so that other texts aren't
    shuffled; beyond that the join that follows drops them."""
    ids = ids.distinct()
    return texts.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= SENT_IDS else texts


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """pairs (a, b) whose full shingle sets reach the threshold. texts: id, data. One text is moved for each pair, and
    that of a once for every STAR pairs of a, so that an id with many pairs is spread over tasks."""
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(1 << 20)).alias("r"))
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("long").alias("salts"))
    pairs = pairs.join(many, "a").select("a", F.expr("pmod(r, salts)").alias("salt"), "b")
    heads = many.select("a", F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"), F.lit(None).cast("long").alias("b"))
    rows = pairs.withColumn("id", F.col("b")).unionByName(heads.withColumn("id", F.col("a")))
    rows = rows.hint("merge").join(needed(texts, rows.select("id")), "id").select("a", "salt", "b", "data")
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(_confirm(words, percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75, bands: int = BANDS, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """Components of documents whose sets of `words`-word shingles have 100 * |A and B| >= percent * |A or B|.

    Returns doc_id, n_shingles, component_id (smallest id reachable), kept (doc_id = component_id). Texts without words
    (also null, empty) have no shingles and stay alone. Rows with one id are one document; of several texts under one id
    the one with the least hash of its set is searched. A null id stays alone with a null component and is kept. An empty table gives no rows; other columns are ignored. A pair is missed only if no
    band agrees (5e-6 at similarity 0.75 with 32 bands of 4) or with probability `miss` by pruning.
    """
    threshold = percent / 100
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), data)
    base = stored(texts.mapInArrow(_sketch(words, bands * rows), "doc_id long, n_shingles long, s1 long, s2 long, sig binary"), "sketches")
    in_play = base.filter("n_shingles > 0 and doc_id is not null")
    several = stored(in_play.groupBy("doc_id").agg(F.min("s1").alias("a"), F.max("s1").alias("b")).filter("a < b").select("doc_id"), "several")
    if not several.isEmpty():  # of an id's texts, one stands for it
        one = in_play.join(several, "doc_id").groupBy("doc_id").agg(F.min(F.struct("s1", "s2")).alias("one"))
        base = base.join(one, "doc_id", "left").withColumns({"s1": F.coalesce("one.s1", "s1"), "own": F.coalesce(F.struct("s1", "s2") == F.col("one"), F.lit(True)), "s2": F.coalesce("one.s2", "s2")})
        base = stored(base.drop("one"), "sketches")
        in_play = base.filter("own and n_shingles > 0 and doc_id is not null")
    classes = in_play.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "sig")).alias("x")).select("s1", "s2", F.col("x.doc_id").alias("id"), F.col("x.sig").alias("sig"))
    classes = stored(classes, "classes")
    sigs = classes.select("id", "sig")

    width = 4 * rows
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width)))))
    banded = classes.select("id", band.alias("band", "key"))
    buckets = stored(banded.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("m")).filter("m > 1"), "buckets")
    members = stored(banded.join(buckets, "key"), "members")

    def pruned(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(sigs.withColumnsRenamed({"id": "a", "sig": "sig_a"}), "a")
        return with_a.join(sigs.withColumnsRenamed({"id": "b", "sig": "sig_b"}), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_prune(threshold, miss), "a long, b long")

    by_id = texts.withColumnRenamed("doc_id", "id")
    nearest = stored(members.groupBy("id").agg(F.min("centre").alias("first")), "nearest")
    star = nearest.filter("id > first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    candidates = stored(pruned(star), "candidates")
    links = stored(confirmed(candidates, by_id, words, percent), "links")
    gone = [several, buckets, members, nearest, candidates]
    labels = stored(components(links), "labels")

    def labelled() -> DataFrame:
        of_centre = labels.withColumnsRenamed({"id": "centre", "component": "of_centre"})
        both = members.join(labels, "id", "left").join(of_centre, "centre", "left")
        return both.select("key", "band", "centre", "id", F.coalesce("component", "id").alias("label"), F.coalesce("of_centre", "centre").alias("centre_label"))

    apart = labelled().filter("label != centre_label").select("centre", "id").distinct().join(nearest, "id").filter("centre != first")
    apart = stored(pruned(apart.select(F.col("centre").alias("a"), F.col("id").alias("b"))), "candidates")
    gone.append(apart)
    if not apart.isEmpty():
        links = links.unionByName(stored(confirmed(apart, by_id, words, percent), "links"))
        labels = stored(components(links), "labels")

    counts = labelled().groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    open_keys = counts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("labels"))
    # with two members left apart, the pair was compared already
    open_keys = open_keys.filter("labels > 1 and m > 2").select("key", F.col("top.label").alias("main"), F.ceil((F.col("m") - F.col("top.n")) / LEFT).cast("long").alias("lefts"), F.ceil(F.col("m") / RIGHT).cast("long").alias("rights"))
    rest = stored(labelled().drop("centre_label").join(stored(open_keys, "open"), "key"), "open_members")
    gone.append(rest)
    if not rest.isEmpty():
        left = rest.filter("label != main").select("*", F.lit(True).alias("is_left"), F.expr("pmod(xxhash64(id), lefts)").alias("i"), F.explode(F.expr("sequence(0L, rights - 1)")).alias("j"))
        right = rest.select("*", F.lit(False).alias("is_left"), F.explode(F.expr("sequence(0L, lefts - 1)")).alias("i"), F.expr("pmod(xxhash64(id, 1), rights)").alias("j"))
        block = F.xxhash64("key", "i", "j").alias("block")
        sides = left.unionByName(right).select(block, "band", "id", "label", "is_left", "centre").join(sigs, "id")
        by_block = lambda df: df.repartition("block").sortWithinPartitions("block")
        near = stored(by_block(sides).mapInArrow(_narrow(threshold, miss, rows), sides.schema), "near")
        gone.append(near)
        if not near.isEmpty():
            with_texts = near.hint("merge").join(needed(by_id, near.select("id")), "id")
            more = stored(by_block(with_texts).mapInArrow(_blocks(threshold, miss, words, percent, rows), "a long, b long").distinct(), "links")
            if not more.isEmpty():
                labels = stored(components(links.unionByName(more)), "labels")

    discard(*gone)
    of_class = classes.select("s1", "s2", "id").join(labels, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
    out = base.select("doc_id", "n_shingles", "s1", "s2").join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op2_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
