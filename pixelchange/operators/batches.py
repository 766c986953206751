"""Rows sorted by pixel, taken by a task in batches of whole pixels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Rows that a task takes together (a longer pixel is taken whole); their arrays fit a cache.
BATCH_ROWS = 4_096


def by_pixel(keys, work, batch_rows: int = BATCH_ROWS):
    """A function for ``mapInArrow``: ``work`` (table -> table) on some whole pixels at a
    time.  Made of closures only, so that it is shipped by value."""
    def last_pixel(t):
        """Where the last pixel's rows begin."""
        start = 0
        for k in keys:
            v = t.column(k).to_numpy()
            other = np.flatnonzero(v != v[-1])
            start = max(start, other[-1] + 1 if len(other) else 0)
        return start

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= batch_rows:
                t = pa.Table.from_batches(held)
                cut = last_pixel(t)
                if cut:
                    yield from work(t.slice(0, cut)).to_batches()
                held, size = t.slice(cut).to_batches(), size - cut
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()

    return run
