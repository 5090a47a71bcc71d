"""Groups of rows that arrive sorted by their keys, one after another, from Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def in_order(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys; only the group at a batch's end waits for the next batch."""
    open_: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in zip(starts, starts[1:]):
            now = tuple(c[low] for c in cols)
            if open_ and now != last:
                yield pa.Table.from_batches(open_)
                open_ = []
            open_.append(batch.slice(low, high - low))
            last = now
    if open_:
        yield pa.Table.from_batches(open_)
