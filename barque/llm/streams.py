"""Groups out of sorted streams of Arrow batches, so that a task holds a few groups and never its whole partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, size: Callable[[pa.Table], np.ndarray], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups of equal `key`, from rows sorted by it. size: the running size of a table's rows; a table
    ends with the group that fills it up to `most`, so only a single group is ever larger."""

    def cut(table: pa.Table) -> Iterator[pa.Table]:
        keys = table.column(key).to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        part = size(table)[starts] // most
        edges = [*starts[np.concatenate(([True], part[1:] != part[:-1]))].tolist(), len(keys)]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            yield table.slice(i, j - i)

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = table.column(key).to_numpy()
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != keys[0]:
            yield from cut(pa.concat_tables(held))
            held = []
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last:
            yield from cut(pa.concat_tables([*held, table.slice(0, last)]))
            held = []
        held.append(table.slice(last))
    if held:
        yield from cut(pa.concat_tables(held))
