"""Linear models on hashed indicator features: bounded fits in one task, scoring in all (operators 5 and 8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.storage import discard, stored

#: Labelled rows that a model is fitted on at most, the first by hash of the id.
FIT_ROWS = 8000
#: Features of all its rows that a fit takes at most: rows come in as long as they fit, each with all of its features.
FIT_FEATURES = 40_000_000


class Model(NamedTuple):
    """Weights by feature id, or by the sorted `keys` of the features that have one; margin to log-odds by slope and shift."""

    w: np.ndarray
    bias: float
    slope: float
    shift: float
    keys: np.ndarray | None = None

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * soft(margin) + self.shift, -30, 30)))

    def margin(self, ids: np.ndarray) -> float:
        """ids: distinct feature ids, or with keys any feature hashes."""
        if self.keys is None:
            return float(self.w[ids].sum(dtype=np.float64)) + self.bias
        if not len(self.keys):
            return self.bias
        at = np.searchsorted(self.keys, ids)
        at[at == len(self.keys)] = 0
        hit = np.unique(at[self.keys[at] == ids])
        return float(self.w[hit].sum(dtype=np.float64)) + self.bias



def held_out(doc_id: Column | str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string").cast("binary")) % 3 == 1


def log_ratios(rows: list[np.ndarray], y: np.ndarray, dim: int, alpha: float = 1.0) -> np.ndarray:
    """Log-count ratio of each feature between the classes y > 0 and y <= 0."""
    counts = [np.full(dim, alpha), np.full(dim, alpha)]
    for ids, label in zip(rows, y, strict=True):
        counts[int(label > 0)][ids] += 1
    return (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())).astype(np.float64)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, cost: np.ndarray, scale: np.ndarray, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of an L1-loss support vector machine by dual coordinate descent; row i's features are
    scale[rows[i]] and a constant 1."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(scale)), 0.0
    values = [scale[ids] for ids in rows]
    norm = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(gradient))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def soft(margin: np.ndarray) -> np.ndarray:
    """Margins with little weight on what lies beyond the support vectors' own, so that far ones don't flatten the
    probability curve; the order stays."""
    return np.clip(margin, -1, 1) + 0.05 * margin


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through soft margins, by Newton steps; targets are smoothed by class size."""
    margin, n1, n0 = soft(margin), (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * a, (p - t).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if a > 0 else (1.0, float(b))


def constant(y: np.ndarray, dim: int) -> Model:
    """Without both classes: the smoothed share of the positive one."""
    p = ((y > 0).sum() + 1) / (len(y) + 2)
    return Model(np.zeros(dim), 0.0, 1.0, float(np.log(p / (1 - p))), None if dim else np.empty(0, np.uint32))


def fit_in_task(docs: DataFrame, labels: DataFrame, label: str, features: Callable[[bytes], np.ndarray], fit: Callable[[list, np.ndarray], Model], max_rows: int, id_col: str, text_col: str, kind: type = np.int32) -> Model:
    """Fit on the first max_rows labelled documents (by hash of id) outside the held-out third; of several texts under one
    id, on one. At most FIT_FEATURES distinct features of each meet in a task; what comes back has the size of the model."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data"))
    rows = rows.join(F.broadcast(known), "doc_id")  # max_rows pairs of numbers

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in enumerate(batch.column("data")):
                ids = np.unique(features(x.as_py()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), batch.column("y").slice(i, 1), pa.array([len(ids)], pa.int64()), pa.array([ids.tobytes()], pa.binary())], ["doc_id", "y", "n", "ids"])

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        y = np.where(table.column("y").to_numpy() > 0, 1, -1)
        ids = [np.frombuffer(x, kind) for x in table.column("ids").to_pylist()]
        m = fit(ids, y)
        binary = lambda x, kind: pa.array([None if x is None else x.astype(kind).tobytes()], pa.binary())
        return pa.table({"w": binary(m.w, np.float32), "bias": [float(m.bias)], "slope": [float(m.slope)], "shift": [float(m.shift)], "keys": binary(m.keys, np.uint32)})

    every = stored(rows.mapInArrow(found, "doc_id long, y int, n long, ids binary"), "labelled")
    sizes = every.groupBy("doc_id").agg(F.max("n").alias("n"))  # max_rows pairs at most
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    fitting = sizes.select("doc_id", upto.alias("upto")).filter(F.col("upto") <= FIT_FEATURES).select("doc_id")
    sample = every.join(F.broadcast(fitting), "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("ids").alias("ids"))
    got = sample.groupBy(F.lit(1).alias("one")).applyInArrow(fitted, "w binary, bias double, slope double, shift double, keys binary").first()
    discard(every)
    if got is None:
        return fit([], np.empty(0, np.int64))
    keys = None if got["keys"] is None else np.frombuffer(got["keys"], np.uint32)
    return Model(np.frombuffer(got["w"], np.float32), got["bias"], got["slope"], got["shift"], keys)


def scored(docs: DataFrame, model: Model, features: Callable[[bytes], np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """doc_id, held_out, score of every row; a null text counts as empty."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = np.array([model.margin(features(x.as_py())) for x in batch.column("data")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(margin), pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data"))
    return rows.mapInArrow(task, "doc_id long, score double").select("doc_id", held_out("doc_id").alias("held_out"), "score")
