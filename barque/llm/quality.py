"""Quality classifier: naive Bayes support vectors on n-gram indicators (operator 5)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barque.llm.linear import FIT_ROWS, Model, constant, dual_descent, fit_in_task, log_ratios, platt, scored
from barque.llm.words import word_hashes

BITS = 17
DIM = 1 << BITS
_N = 64  # reserved features at the start
#: Shape of a byte: letters a and A, digits 0, white space, the rest as it is.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[65:91] = 65
SHAPE[48:58] = 48
SHAPE[[32, *range(9, 14)]] = 32
_MARKS: dict[int, np.ndarray] = {}


def _hash(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    return (x >> np.uint32(32 - BITS)).astype(np.int32)


def distinct(parts: list[np.ndarray], dim: int) -> np.ndarray:
    """Sorted distinct ids, through marks that are kept for the next text."""
    mark = _MARKS.setdefault(dim, np.zeros(dim, bool))
    for p in parts:
        mark[p] = True
    out = np.flatnonzero(mark)
    mark[out] = False
    return out


def features(data: bytes) -> np.ndarray:
    """Indicators: byte 3-grams, 4-grams of the run-free shape of the text, runs and share of repeated words, emptiness."""
    raw = np.frombuffer(data, np.uint8)
    parts = []
    if len(raw) >= 3:
        x = raw.astype(np.uint32)
        parts.append(_hash(x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16) | np.uint32(1 << 24)))
    shape = SHAPE[raw]
    if len(shape) > 1:
        shape = shape[np.concatenate(([True], shape[1:] != shape[:-1]))]
    if len(shape) >= 4:
        x = shape.astype(np.uint32)
        parts.append(_hash((x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)) ^ np.uint32(0xA5A5A5A5)))
    words = word_hashes(data)
    own = [0] if not len(words) else []
    if len(words) > 1:
        same = words[1:] == words[:-1]
        share = same.mean()
        own.append(1 + int(np.searchsorted((0.005, 0.02, 0.05, 0.1, 0.3, 0.6), share, "right")))
        for run in (2, 3, 4):  # of equal neighbours
            if len(same) >= run and np.lib.stride_tricks.sliding_window_view(same, run).all(axis=1).any():
                own.append(8 + run)
    parts.append(np.array(own, np.int32))
    return distinct([np.maximum(p, _N) if i < len(parts) - 1 else p for i, p in enumerate(parts)], DIM).astype(np.int32)


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """Scale by log-count ratios, fit the hinge loss on four fifths, the probability curve on the last fifth."""
    if len(set(y)) < 2 or min((y > 0).sum(), (y < 0).sum()) < 5:
        return constant(y, DIM)
    rest = np.arange(len(rows)) % 5 == 4
    if len(set(y[rest])) < 2:
        rest[:] = True
        train = np.arange(len(rows))
    else:
        train = np.flatnonzero(~rest)
    some, label = [rows[i] for i in train], y[train]
    ratio = log_ratios(some, label, DIM)
    ratio /= np.abs(ratio).max()
    even = len(label) / (2 * np.where(label > 0, (label > 0).sum(), (label < 0).sum()))
    w, bias = dual_descent(some, label, even, ratio)
    w = w * ratio
    margin = np.array([w[rows[i]].sum() + bias for i in np.flatnonzero(rest)])
    return Model(w, bias, *platt(margin, y[rest]))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better), predicted (1 from 0.5 on) of every whole text.

    Fitted on at most max_rows labelled rows (doc_id, quality) outside the held-out third; inputs are the text alone.
    Null labels are no labels; without labels of both kinds every score is the smoothed share of good ones. A null or
    empty text has a score like any other; a null id stays null; an empty table gives no rows; other columns are ignored.
    """
    model = fit_in_task(docs, labels, "quality", features, fit, max_rows, id_col, text_col)
    return scored(docs, model, features, id_col, text_col).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
