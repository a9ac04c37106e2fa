"""Figures of column pairs over a block of rows; blocks are added up by the caller."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: A block ends after as many rows, or bytes.
ROWS, BYTES = 100_000, 64_000_000


def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= ROWS or size >= BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def cells(block: pa.Table, sides: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """``pair, x, y, n``: the non-empty cells of pairs of text columns, given by their places."""
    coded = []
    for column in block.columns:
        column = pa.concat_arrays(column.chunks).dictionary_encode()
        codes = column.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        coded.append((codes, column.dictionary))
    for pair, (a, b) in enumerate(sides):
        (x, xs), (y, ys) = coded[a], coded[b]
        there = (x >= 0) & (y >= 0)
        if not there.any():
            continue
        keys = x[there] * len(ys) + y[there]
        if len(xs) * len(ys) <= len(keys):
            n = np.bincount(keys)
            found = np.flatnonzero(n)
            n = n[found]
        else:
            found, n = np.unique(keys, return_counts=True)
        columns = [
            pa.array(np.full(len(found), pair, np.int32)),
            xs.take(pa.array(found // len(ys))),
            ys.take(pa.array(found % len(ys))),
            pa.array(n.astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["pair", "x", "y", "n"])


def moments(block: pa.Table, sides: Sequence[tuple[int, int]]) -> pa.RecordBatch:
    """``pair, n, x, y, xx, yy, xy``: rows where both numbers are present, their means, and the sums of
    squares and products about these. They are exactly 0 for a number that does not vary."""
    numbers = [column.to_numpy() for column in block.columns]
    there = [~np.isnan(x) for x in numbers]
    rows = []
    with np.errstate(all="ignore"):
        for pair, (a, b) in enumerate(sides):
            both = there[a] & there[b]
            if not both.any():
                continue
            x, y = (numbers[c] if both.all() else numbers[c][both] for c in (a, b))
            dx, dy = x - x[0], y - y[0]
            mx, my = dx.mean(), dy.mean()
            dx, dy = dx - mx, dy - my
            rows.append((pair, len(x), x[0] + mx, y[0] + my, dx @ dx, dy @ dy, dx @ dy))
    names = ["pair", "n", "x", "y", "xx", "yy", "xy"]
    types = [pa.int32(), pa.int64(), *[pa.float64()] * 5]
    values = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)
