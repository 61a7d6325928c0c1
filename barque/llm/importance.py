"""Target-distribution importance resampling (operator 13).

Hashed n-gram counts of all documents and of all target texts give each bucket a gain; a document's weight is the mean gain
of its features, read from an array by bucket. Weight plus Gumbel noise is the score, and the highest scores are drawn. The
cutoff is found by weighted medians of medians: each partition gives the median of the keys still in question, the median of
those, weighted by how many keys each stands for, is the pivot, and at least a quarter of the keys falls away with every
pass. Winners alone are sorted, by ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.sqlwords import NO_LETTER, lower_az, split_words
from barque.llm.storage import discard, partitions, stored

BUCKETS, LONGEST, SEED = 10_000, 1, "2024"
LEAST_WORDS, PERCENT = 20, 10
MOST_BUCKETS = 100_000  # the gains travel with the plan


def runs_of(words: Column, longest: int) -> Column:
    """All runs of 1 to `longest` consecutive words, joined by one space."""
    if longest == 1:
        return words
    each = lambda n: F.transform(F.slice(words, F.lit(n), F.greatest(F.size(words), F.lit(0))), lambda w, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))
    return F.concat(*(each(n) for n in range(1, longest + 1)))


def bucket(feature: Column | str, buckets: int) -> Column:
    return (F.crc32(F.col(feature).cast("binary") if isinstance(feature, str) else feature.cast("binary")) % buckets).cast("int")


def featured(docs: DataFrame, text_col: str, longest: int, *columns: Column) -> DataFrame:
    """columns, n_words and features of each row; a null text has none."""
    rows = docs.select(*columns, split_words(lower_az(F.coalesce(F.col(text_col), F.lit(""))), NO_LETTER).alias("words"))
    names = [c for c in rows.columns if c != "words"]
    return rows.select(*names, F.size("words").alias("n_words"), runs_of(F.col("words"), longest).alias("features"))


def bucket_counts(docs: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    return featured(docs, text_col, longest).select(F.explode("features").alias("f")).groupBy(bucket("f", buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text_col: str = "text") -> list[int]:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) by bucket: s of S features of docs, t of T of the target lie in it."""
    spark = docs.sparkSession
    of_docs = stored(bucket_counts(docs, text_col, longest, buckets).withColumnRenamed("n", "s"), "counts")
    of_target = stored(bucket_counts(target, text_col, longest, buckets).withColumnRenamed("n", "t"), "target_counts")
    (all_s,), (all_t,) = of_docs.agg(F.coalesce(F.sum("s"), F.lit(0))).first(), of_target.agg(F.coalesce(F.sum("t"), F.lit(0))).first()
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(of_docs, "bucket", "left").join(of_target, "bucket", "left").fillna(0)
    above = (F.col("t").cast("double") + 1) * F.lit(float(all_s + buckets))
    below = (F.col("s").cast("double") + 1) * F.lit(float(all_t + buckets))
    found = both.select("bucket", F.floor(1000 * F.log(above / below)).cast("long").alias("gain")).collect()  # a row for each bucket
    discard(of_docs, of_target)
    return [g for _, g in sorted((r.bucket, r.gain) for r in found)]


class Key(NamedTuple):
    """Keys go from the best down: higher scores first, then smaller ids."""

    score: int
    id: int


def _middle(score: np.ndarray, ids: np.ndarray) -> tuple[int | None, int | None, int]:
    """The median key and the number of keys."""
    if not len(score):
        return None, None, 0
    middle = np.lexsort((ids, -score))[(len(score) - 1) // 2]
    return int(score[middle]), int(ids[middle]), len(score)


SIDES = "better_score long, better_id long, better long, equal long, worse_score long, worse_id long, worse long"


def _sides(above: Key | None, below: Key | None, pivot: Key | None):
    """Of the partition's keys between the bounds (both exclusive): the medians and numbers of those better and worse than
    the pivot, and the number equal to it. Without a pivot all count as worse."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            score, ids = batch.column("score").to_numpy(), batch.column("id").to_numpy()
            keep = np.ones(len(score), bool)
            if above:
                keep &= (score < above.score) | (score == above.score) & (ids > above.id)
            if below:
                keep &= (score > below.score) | (score == below.score) & (ids < below.id)
            parts.append((score[keep], ids[keep]))
        if not parts:
            return
        score, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        equal, better = np.zeros(len(score), bool), np.zeros(len(score), bool)
        if pivot:
            equal = (score == pivot.score) & (ids == pivot.id)
            better = (score > pivot.score) | (score == pivot.score) & (ids < pivot.id)
        worse = ~equal & ~better
        row = [*_middle(score[better], ids[better]), int(equal.sum()), *_middle(score[worse], ids[worse])]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], [c.split()[0] for c in SIDES.split(", ")])

    return task


def _weighted_median(medians: list[tuple[Key, int]]) -> Key:
    medians = sorted(medians, key=lambda x: (-x[0].score, x[0].id))
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def kth_key(keys: DataFrame, k: int) -> Key:
    """The k-th best of keys (score long, id long; k from 1 to their number). Each pass gives one row per partition to the
    driver; a partition's keys meet in its task."""
    above = below = pivot = None
    while True:
        found = keys.mapInArrow(_sides(above, below, pivot), SIDES).collect()
        better, equal = sum(r.better for r in found), sum(r.equal for r in found)
        if pivot and better < k <= better + equal:
            return pivot
        if pivot and k <= better:
            below, medians = pivot, [(Key(r.better_score, r.better_id), r.better) for r in found if r.better]
        else:
            if pivot:
                above, k = pivot, k - better - equal
            medians = [(Key(r.worse_score, r.worse_id), r.worse) for r in found if r.worse]
        pivot = _weighted_median(medians)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null where it is not drawn.

    Of the rows with at least `least_words` words, `percent` in a hundred (rounded down) are drawn, highest scores first,
    ties to smaller ids. A null text counts as empty, and without features the weight is 0. Repeated rows are drawn each
    for itself; a null id hashes as an empty one, has a score and is never drawn. An empty table gives no rows, an empty
    target no features; other columns are ignored.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets")
    table = F.split(F.lit(",".join(map(str, gains(docs, target, buckets, longest, text_col)))), ",").cast("array<bigint>")
    doc_id = F.col(id_col).cast("long")
    rows = featured(docs, text_col, longest, doc_id.alias("doc_id"))
    total = F.aggregate("features", F.lit(0).cast("long"), lambda a, f: a + F.get(table, bucket(f, buckets)))
    rows = rows.select("doc_id", "n_words", F.size("features").cast("long").alias("n_features"), total.alias("total"))
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = rows.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise)
    scored = stored(rows, "scored")

    may = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    # rows of a null id count for the share, but are not drawn
    long_enough, able = scored.agg(F.count(F.when(F.col("n_words") >= least_words, 1)), F.count(F.when(may, 1))).first()
    drawn = min(percent * long_enough // 100, able)
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select(*out, none)
    cut = kth_key(scored.filter(may).select("score", F.col("doc_id").alias("id")), drawn)
    wins = may & ((F.col("score") > cut.score) | (F.col("score") == cut.score) & (F.col("doc_id") <= cut.id))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    winners = scored.filter(wins).repartitionByRange(partitions(scored.sparkSession), *order[:2])
    winners = stored(winners.select(*out, F.spark_partition_id().alias("range")), "winners")
    sizes = winners.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.col("base") + F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = winners.join(F.broadcast(bases), "range").select(*out, rank.cast("long").alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))  # rows equal in score and id may reach past the share
    return ranked.unionByName(scored.filter(~wins).select(*out, none))


def op13_resample(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
