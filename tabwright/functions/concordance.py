"""Agreeing less disagreeing pairs of rows, without comparing rows with rows."""

from __future__ import annotations

import numpy as np


def _pairs(counts: np.ndarray) -> int:
    counts = counts.astype(np.int64)
    return int((counts * (counts - 1) // 2).sum())


def inversions(codes: np.ndarray, top: int) -> int:
    """Pairs of places whose earlier code is the greater one; codes are 0 to ``top``.

    Codes are split bit by bit, the highest first, in their order. Two codes part at one bit, inside the
    group that shares the bits above: there an earlier 1 and a later 0 are a pair.
    """
    found, codes = 0, codes.astype(np.int64)
    for bit in reversed(range(int(top).bit_length())):
        group = codes >> (bit + 1)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(np.append(starts, len(codes)))
        one = (codes >> bit) & 1
        upto = np.cumsum(one)
        before = upto[starts] - one[starts]
        ones = np.add.reduceat(one, starts) if len(starts) else before
        found += int(upto[one == 0].sum()) - int(((sizes - ones) * before).sum())
        # zeros of a group first, each half in its order
        earlier = np.repeat(before, sizes)
        start = np.repeat(starts, sizes)
        ones_before = upto - one - earlier
        zeros = np.repeat(sizes - ones, sizes)
        places = np.arange(len(codes))
        at = np.where(one == 1, start + zeros + ones_before, places - ones_before)
        moved = np.empty_like(codes)
        moved[at] = codes
        codes = moved
    return found


def ranked(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense codes in the order of the values, and their number."""
    distinct, codes = np.unique(values, return_inverse=True)
    return codes.astype(np.int64), len(distinct)


def balance(x: np.ndarray, y: np.ndarray, xs: int, ys: int) -> tuple[int, int]:
    """Agreeing less disagreeing pairs of rows by codes below ``xs`` and ``ys``, and the pairs tied in ``x``."""
    if len(x) < 2:
        return 0, 0
    both = np.sort(x * ys + y)
    runs = np.diff(np.append(np.flatnonzero(np.diff(both, prepend=-1)), len(both)))
    tied_x = _pairs(np.bincount(x))
    every = len(x) * (len(x) - 1) // 2
    other = every - tied_x - _pairs(np.bincount(y)) + _pairs(runs)
    return other - 2 * inversions(both % ys, ys - 1), tied_x


def grid_balance(grid: np.ndarray) -> float:
    """The same for counted cells, ordered along both axes."""
    below = np.zeros((grid.shape[0] + 1, grid.shape[1] + 1))
    below[1:, 1:] = grid.cumsum(0).cumsum(1)
    # rows with a smaller x: those with a smaller y agree, those with a greater y do not
    agree, smaller = below[:-1, :-1], below[:-1, -1:]
    return float((grid * (agree - (smaller - below[:-1, 1:]))).sum())
