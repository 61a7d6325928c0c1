"""Corpus pipeline: documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on everything that the one before it kept. All but the last return the
columns of `docs`; where a stage changes texts, n_chars follows. Nulls in any column, empty texts and tables, repeated
rows and further columns pass; a null text counts as empty. Further columns may have any name but those that begin with
two underscores. Of rows equal in id and text the second stage keeps one; texts that differ under one id are one document
to it, and all stay or go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barque.llm import neardup, packing, quality, repeats, secrets
from barque.llm.linear import FIT_ROWS, fit_in_task
from barque.llm.storage import discard, stored


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """docs with another text, and n_chars of it where there is such a column."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects (score under one half). Rows are judged where they are read."""
    model = fit_in_task(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", quality.features, quality.fit, FIT_ROWS, "doc_id", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            margin = np.array([model.margin(quality.features((x.as_py()).encode())) for x in texts])
            yield batch.filter(pa.array(model.score(margin) >= 0.5))

    return docs.mapInArrow(task, docs.schema)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each component of near duplicates, once. Documents without an id stay."""
    found = neardup.near_duplicates(docs)
    keep = found.filter("kept and doc_id is not null").select(F.col("doc_id").cast("long").alias("__id")).distinct()
    known = docs.filter("doc_id is not null").withColumns({"__id": F.col("doc_id").cast("long"), "__k1": F.xxhash64("text"), "__k2": F.xxhash64(F.lit(1), F.col("text"))})
    kept = known.join(keep, "__id", "left_semi")
    if not known.groupBy("__id", "__k1", "__k2").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__id", "__k1", "__k2"])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of passages of 200 bytes and more; the first copy stays. No row goes."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data")
    names = repeats.keyed(docs, "doc_id", "text")
    spans = repeats.repeated_spans(docs.select(*names, data), earlier_only=True).groupBy("id", "k1").agg(F.collect_list(F.struct("s", "e")).alias("__spans"))
    spans = spans.withColumnsRenamed({"id": "__id", "k1": "__k1"})
    keyed = docs.withColumns({"__id": names[0], "__k1": names[1]})
    cut = repeats.cut_text()
    joined = keyed.join(spans, ["__id", "__k1"], "left")
    out = _with_text(joined, F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut("text", "__spans")))
    return out.select(docs.columns)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mask. No row goes."""
    paths, ledger = secrets.scan(docs)
    found = secrets.findings(paths, ledger)
    kinds = [f"spans_{r.kind}" for r in secrets.RULES]
    hits = found.filter(" or ".join(f"size({k}) > 0" for k in kinds)).groupBy("id", "blob").agg(*(F.first(k).alias(f"__{k}") for k in kinds))
    id_, blob = secrets.address(docs, "doc_id", "text")
    keyed = docs.withColumns({"__id": id_, "__blob": blob})
    joined = keyed.join(hits.withColumnsRenamed({"id": "__id", "blob": "__blob"}), ["__id", "__blob"], "left")
    masked = secrets.masked(F.coalesce("text", F.lit("")), prefix="__spans_")
    return _with_text(joined, F.when(F.col("__spans_hex").isNull(), F.col("text")).otherwise(masked)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, one row per piece (see barque.llm.packing)."""
    return packing.pack(docs, packing.vocabulary(), with_ids=False)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("repeats", without_repeats),
    ("secrets", masked_secrets),
    ("packing", packed),
]
#: SQL can't express the classifier, MinHash or the tokenizer; tests/llm compares each stage with a plain version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each on all that the one before it kept, written as Parquet and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    try:
        for name, stage in STAGES[:-1]:
            after = stored(stage(spark, docs, sf_dir), name)
            if before is not None:
                discard(before)
            docs = before = after
        return STAGES[-1][1](spark, docs, sf_dir)  # packing has stored the tokens when it returns
    finally:
        if before is not None:
            discard(before)
