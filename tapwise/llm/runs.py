"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each run of equal keys begins in a sorted table of integer keys."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The batches as tables that no run crosses; holds one batch and one run at a time."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        last = int(starts(table, keys)[-1])
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None:
        yield held
