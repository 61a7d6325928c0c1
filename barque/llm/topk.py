"""Exact top-k by inner product through global score histograms (operator 10).

All rows are scored against all queries in blocks: candidates are packed into blocks of bounded size, queries too, and
each candidate block meets each query block once, over an equi-join on (query block, share). Scores never leave the
task. What leaves is, for each query, a histogram of its scores; the histograms are added up, the bin with the k-th
score is found, and the next round divides that bin, until bins are one score wide. Then the k-th score is known, and a
last pass lets through what is above it and, of its ties, the k smallest ids of each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.storage import discard, partitions, stored

SCALE, K, EVERY = 1024, 10, 100
CANDIDATES, QUERIES, BINS = 1024, 2048, 4096
LONGEST = (1 << 63) - 1  # what a long holds
OFFSET = 1 << 63  # histograms are over score + OFFSET, which 64 bits without a sign hold


def _vectors(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: ids and integer components of the rows without null or non-finite components."""
    out: dict[int, tuple[list, list]] = {}
    for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v"), strict=True):
        if i is None or not v.is_valid or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False)
        if np.isfinite(x).all():
            ids, rows = out.setdefault(len(x), ([], []))
            ids.append(i)
            rows.append(np.floor(SCALE * x))
    return {n: (np.array(ids, np.int64), np.array(rows, np.float64).reshape(len(ids), n)) for n, (ids, rows) in out.items()}


BLOCK = "dim int, reach double, ids binary, rows binary"


def _block(dim: int, ids: np.ndarray, rows: np.ndarray) -> dict:
    """Components as 32-bit integers where they fit, else as doubles, which are exact."""
    reach = float(np.sqrt((rows**2).sum(axis=1)).max(initial=0))
    small = np.abs(rows).max(initial=0) < 1 << 31
    return {"dim": dim, "reach": reach, "ids": ids.tobytes(), "rows": rows.astype(np.int32 if small else np.float64).tobytes()}


def _unpacked(rows: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(rows, np.int32 if len(rows) == n * dim * 4 else np.float64).astype(np.float64).reshape(n, dim)


_BLOCK = pa.schema([("dim", pa.int32()), ("reach", pa.float64()), ("ids", pa.binary()), ("rows", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, (ids, rows) in _vectors(batch).items():
            for at in range(0, len(ids), CANDIDATES):
                yield pa.RecordBatch.from_pylist([_block(dim, ids[at : at + CANDIDATES], rows[at : at + CANDIDATES])], _BLOCK)


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbered blocks of QUERIES rows at most, from rows dealt out evenly, whatever their ids."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for dim, (ids, rows) in _vectors(batch).items():
            for at in range(0, len(ids), QUERIES):
                block = {"qb": number} | _block(dim, ids[at : at + QUERIES], rows[at : at + QUERIES])
                number += 1
                yield pa.RecordBatch.from_pylist([block], pa.schema([("qb", pa.int64()), *_BLOCK]))


def _scores(row: dict, q_rows: bytes, q_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact integer scores (queries x candidates), candidate ids, and which pairs count."""
    dim = row["dim"]
    ids = np.frombuffer(row["ids"], np.int64)
    c, q = _unpacked(row["rows"], len(ids), dim), _unpacked(q_rows, len(q_ids), dim)
    bound = dim * float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0))
    if bound < 2**53:
        scores = np.rint(q @ c.T).astype(np.int64)
    elif bound < 2**62:
        scores = q.astype(np.int64) @ c.astype(np.int64).T
    else:  # integers of any size; what a long can't hold becomes the nearest that it holds
        whole = lambda x: np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
        scores = np.clip(whole(q) @ whole(c).T, -LONGEST - 1, LONGEST).astype(np.int64)
    return scores, ids, ids[None, :] != q_ids[:, None]


def _best(scores: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Drop what k others of this block surpass: it can't reach the k-th score."""
    if scores.shape[1] > k:
        low = np.where(counts, scores, np.iinfo(np.int64).min)
        counts = counts & (low >= np.partition(low, -k, axis=1)[:, -k][:, None])
    return counts


def _histogram(k: int):
    """Rows: one block pair with the range of each query that is still open; out: (qb, q, bin, n)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                scores, _, counts = _scores(row, row["q_rows"], q_ids)
                low = np.frombuffer(row["low"], np.uint64)[:, None]
                width = np.frombuffer(row["width"], np.uint64)[:, None]
                counts = _best(scores, counts, k)
                scores = scores.view(np.uint64) ^ np.uint64(OFFSET)  # score + OFFSET
                counts = counts & (scores >= low)
                bins = np.minimum((scores - np.minimum(low, scores)) // width, np.uint64(BINS)).astype(np.int64)  # BINS: above the range, counted before
                q, c = np.nonzero(counts)
                key, n = np.unique(q * (BINS + 1) + bins[q, c], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), row["qb"])), pa.array(row["dim"] + np.zeros(len(key), np.int32), pa.int32()), pa.array((key // (BINS + 1)).astype(np.int32)), pa.array((key % (BINS + 1)).astype(np.int32)), pa.array(n.astype(np.int64))], ["qb", "dim", "q", "bin", "n"])

    return task


def _select(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                scores, ids, counts = _scores(row, row["q_rows"], q_ids)
                kth = (np.frombuffer(row["low"], np.uint64) ^ np.uint64(OFFSET)).view(np.int64)[:, None]
                q, c = np.nonzero(_best(scores, counts, k) & (scores >= kth))
                order = np.lexsort((ids[c], -scores[q, c], q))
                q, c = q[order], c[order]
                first = np.searchsorted(q, q)  # of this query
                top = np.arange(len(q)) - first < k
                q, c = q[top], c[top]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), row["qb"])), pa.array(np.full(len(q), row["dim"], np.int32)), pa.array(q.astype(np.int32)), pa.array(q_ids[q]), pa.array(ids[c]), pa.array(scores[q, c])], ["qb", "dim", "q", "query_id", "vec_id", "score"])

    return task


def _ranges(found: np.ndarray) -> bytes:
    return found.astype(np.uint64).tobytes()


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best candidates of each query row (id divisible by `every`) among all rows with another id.

    Components become floor(1024 x) and scores are exact integer inner products. Returns query_id, rank, vec_id, score;
    ties go to smaller ids. Rows with a null id, a null vector or a null or non-finite component take no part; vectors
    of another length than the query's are no candidates for it. Repeated rows are queries and candidates each for
    itself. Scores are exact as far as a long holds them; beyond they are the nearest long. Fewer than k candidates: all of them; empty tables: no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    blocks = stored(rows.mapInArrow(_pack, BLOCK), "candidates")
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_blocks = max(1, -(-queries.count() // QUERIES))
    packed = stored(queries.repartition(n_blocks).mapInArrow(_pack_queries, f"qb long, {BLOCK}"), "queries")
    reach = blocks.agg(F.max("reach")).first()[0]
    if reach is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packed = packed.select("qb", "dim", F.col("reach").alias("q_reach"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"))

    shares = partitions(spark)
    every_share = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share")
    of_query = packed.select("qb", "dim").distinct().select("qb", "dim", every_share)
    # by length and share, so that the one length of most tables is no hot key
    candidates = blocks.select("dim", "ids", "rows", F.pmod(F.xxhash64("ids"), F.lit(shares)).alias("share")).join(of_query, ["dim", "share"])

    def scored(ranges: DataFrame) -> DataFrame:
        """Each candidate block with each query block of its length, and that block's ranges."""
        side = packed.join(ranges, ["qb", "dim"]).select("*", every_share)
        return candidates.join(side, ["qb", "dim", "share"]).select("qb", "dim", "ids", "rows", "q_ids", "q_rows", "low", "width")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                span = row["q_reach"] * reach * 1.000001 + 2  # no number where a vector is beyond what a double holds
                most = int(span) if span < OFFSET else OFFSET
                n = len(row["q_ids"]) // 8
                width = max(1, -(-(2 * most + 1) // BINS))
                out = {"qb": row["qb"], "dim": row["dim"], "low": _ranges(np.full(n, OFFSET - most, np.uint64)), "width": _ranges(np.full(n, width, np.uint64))}
                yield pa.RecordBatch.from_pylist([out], _RANGES)

    ranges = stored(packed.select("qb", "dim", "q_reach", "q_ids").mapInArrow(start, RANGES), "ranges")
    open_ = True
    while open_:
        n = scored(ranges).mapInArrow(_histogram(k), "qb long, dim int, q int, bin int, n long").groupBy("qb", "dim", "q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("qb", "dim", "q").orderBy(F.col("bin").desc())
        at = n.withColumn("cum", F.sum("n").over(down)).groupBy("qb", "dim", "q").agg(F.max(F.when(F.col("cum") >= k, F.col("bin"))).alias("bin"))
        at = at.groupBy("qb", "dim").agg(F.collect_list(F.struct("q", F.coalesce("bin", F.lit(-1)).alias("bin"))).alias("at"))
        ranges, last = stored(ranges.join(at, ["qb", "dim"], "left").mapInArrow(_narrow, RANGES), "ranges"), ranges
        discard(last)
        open_ = bool(ranges.filter("more").limit(1).count())
    found = scored(ranges).mapInArrow(_select(k), "qb long, dim int, q int, query_id long, vec_id long, score long")
    best = Window.partitionBy("qb", "dim", "q").orderBy(F.col("score").desc(), "vec_id")
    out = stored(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "best")
    discard(blocks, packed, ranges)
    return out


RANGES = "qb long, dim int, low binary, width binary, more boolean"
_RANGES = pa.schema([("qb", pa.int64()), ("dim", pa.int32()), ("low", pa.binary()), ("width", pa.binary()), ("more", pa.bool_())])


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Go to the bin that holds the k-th score; without one (fewer than k candidates) everything passes."""
    for batch in batches:
        for row in batch.to_pylist():
            low, width = (np.frombuffer(row[c], np.uint64).copy() for c in ("low", "width"))
            bins = np.full(len(low), -1)
            for x in row["at"] or []:
                bins[x["q"]] = x["bin"]
            none = bins < 0
            low = np.where(none, low, low + np.clip(bins, 0, BINS).astype(np.uint64) * width)
            done = none | (width == 1)
            width = np.where(done, np.uint64(1), (width + np.uint64(BINS - 1)) // np.uint64(BINS))
            yield pa.RecordBatch.from_pylist([{"qb": row["qb"], "dim": row["dim"], "low": _ranges(low), "width": _ranges(width), "more": bool((~done).any())}], _RANGES)


def op10_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
