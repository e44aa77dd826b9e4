"""Work on the rows of one key together, as runs of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def run_bounds(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs of equal integer keys begin, and the number of rows."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = rows.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), rows.num_rows)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, np.ndarray | None]]:
    """The rows of a partition that is sorted by integer ``keys``, with the bounds of their runs.

    No run is cut, unless it has more than ``most`` rows and goes beyond a batch: its rows then come alone,
    in parts, with None for bounds, so that memory stays bounded. Longer runs may also come whole.
    """
    held: pa.Table | None = None
    long_key = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if long_key is not None:
            same = np.ones(rows.num_rows, bool)
            for k, v in zip(keys, long_key):
                same &= rows.column(k).to_numpy() == v
            n = int(same.argmin()) if not same.all() else rows.num_rows
            if n:
                yield rows.slice(0, n), None
                rows = rows.slice(n)
            if not rows.num_rows:
                continue
            long_key = None
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        bounds = run_bounds(held, keys)
        last = int(bounds[-2]) if held.num_rows else 0
        if last:
            yield held.slice(0, last), bounds[:-1]
            held = held.slice(last)
        if held.num_rows > most:
            yield held, None
            long_key, held = [held.column(k)[0].as_py() for k in keys], None
    if held is not None and held.num_rows:
        yield held, run_bounds(held, keys)


class Sets:
    """Disjoint sets of the numbers below n."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def unite(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
