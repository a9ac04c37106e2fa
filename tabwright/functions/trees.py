"""Gradient-boosted trees as Spark ML grows them, from rows kept as one small code per column.

Spark keeps every slot of a feature vector as an integer and adds every row to a histogram of every slot. Here
the slots of a one-hot column are one code, which says which of them is set, so a row is a byte or two for each
column of the table. Thresholds, draws of rows and of features, gains, and the order in which equal gains are
settled are Spark's, and so are the trees.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

INVALID, EPSILON = -np.finfo(float).max, np.finfo(float).eps


# --- Spark's random numbers ----------------------------------------------------------

_MASK = 0xFFFFFFFF


def _murmur(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & _MASK
        k = ((k << 15 | k >> 17) & _MASK) * 0x1B873593 & _MASK
        h ^= k
        h = ((h << 13 | h >> 19) & _MASK) * 5 + 0xE6546B64 & _MASK
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & _MASK
    return h ^ h >> 16


def _hash_seed(seed: int) -> int:
    data = (seed & (2**64 - 1)).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state = state ^ (state >> np.uint64(35))
    return state ^ (state << np.uint64(4))


def _next_double(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = _step(state)
    second = _step(first)
    bits = ((first & np.uint64(2**26 - 1)) << np.uint64(27)) + (second & np.uint64(2**27 - 1))
    return bits.astype(np.float64) * 2.0**-53, second


def _apply(matrix: np.ndarray, state: np.ndarray) -> np.ndarray:
    """A matrix over bits, given by what it makes of each bit, times every state."""
    out = np.zeros_like(state)
    for bit in range(64):
        out ^= matrix[bit] * ((state >> np.uint64(bit)) & np.uint64(1))
    return out


def _jump(steps: int) -> np.ndarray:
    """What ``steps`` steps of the generator make of each bit."""
    done = power = np.uint64(1) << np.arange(64, dtype=np.uint64)
    power = _step(power)
    while steps:
        if steps & 1:
            done = _apply(power, done)
        power, steps = _apply(power, power), steps >> 1
    return done


_RUN = 128


def _doublings(steps: int, n: int) -> list[np.ndarray]:
    found = [_jump(steps)]
    while len(found) < n:
        found.append(_apply(found[-1], found[-1]))
    return found


#: how to skip 1, 2, 4, ... runs of ``_RUN`` draws
_AHEAD = _doublings(2 * _RUN, 24)


def uniforms(seed: int, offset: int, n: int) -> np.ndarray:
    """Draws ``offset`` to ``offset + n`` of Spark's ``XORShiftRandom`` under ``seed``."""
    state = _apply(_jump(2 * offset), np.array([_hash_seed(seed)], dtype=np.uint64))
    for ahead in _AHEAD:
        if len(state) * _RUN >= n:
            break
        state = np.concatenate([state, _apply(ahead, state)])
    out = np.empty((_RUN, len(state)))
    for i in range(_RUN):
        out[i], state = _next_double(state)
    return out.T.ravel()[:n]


class _JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (2**48 - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (2**48 - 1)
        word = self.state >> 16
        return word - 2**32 if word >= 2**31 else word

    def next_long(self) -> int:
        return (self._next() << 32) + self._next() & (2**64 - 1)


def feature_subsets(seeds: Sequence[int], features: int, kept: int) -> np.ndarray:
    """The features a node may split on, in Spark's order: a reservoir of ``kept`` for each seed."""
    reservoir = np.tile(np.arange(kept), (len(seeds), 1))
    state = np.array([_hash_seed(s) for s in seeds], dtype=np.uint64)
    for item in range(kept, features):
        u, state = _next_double(state)
        place = (u * (item + 1)).astype(np.int64)
        rows = np.flatnonzero(place < kept)
        reservoir[rows, place[rows]] = item
    return reservoir


# --- rows as codes -------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Which column of codes holds a feature, and how. ``code`` is 0 for a number, whose codes are its
    bins; a slot that is 0 or 1 has the code that stands for 1 in its column."""

    column: np.ndarray
    code: np.ndarray
    thresholds: list[np.ndarray | None]
    sizes: np.ndarray
    zero: np.ndarray

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    @property
    def slots(self) -> np.ndarray:
        return np.flatnonzero(self.code)

    @property
    def numbers(self) -> np.ndarray:
        """Numbers that have a threshold at all."""
        return np.array([f for f, t in enumerate(self.thresholds) if t is not None and len(t)], dtype=np.int64)


def layout_of(names: Sequence[str], thresholds: list[np.ndarray | None], prefixes: Sequence[str]) -> Layout:
    """``thresholds`` has None for a slot of two values. Slots whose names share a prefix are one column."""
    column, code = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    sizes, zero, groups = [], [], {}
    for f, name in enumerate(names):
        if thresholds[f] is not None:
            column[f] = len(sizes)
            sizes.append(len(thresholds[f]) + 1)
            zero.append(int(np.searchsorted(thresholds[f], 0.0)))
            continue
        group = max((p for p in prefixes if name.startswith(p)), key=len, default=f)
        if group not in groups:
            groups[group] = len(sizes)
            sizes.append(1)
            zero.append(0)
        column[f], code[f] = groups[group], sizes[groups[group]]
        sizes[groups[group]] += 1
    return Layout(column, code, thresholds, np.array(sizes), np.array(zero))


#: rows of one partition: its number, that of the first row in it, codes by column, labels -1 and 1, margins so far
Block = tuple[int, int, np.ndarray, np.ndarray, np.ndarray]


def encode_rows(batch: pa.RecordBatch, layout: Layout, dtype) -> tuple[np.ndarray, np.ndarray]:
    label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
    vectors, n = batch.column(1), batch.num_rows
    kind = vectors.field("type").to_numpy(zero_copy_only=False)
    values, indices = vectors.field("values"), vectors.field("indices")
    length = np.asarray(values.value_lengths().fill_null(0))
    rows = np.repeat(np.arange(n), length)
    value = np.asarray(values.flatten())
    feature = np.arange(len(value)) - np.repeat(np.cumsum(length) - length, length)
    feature[kind[rows] == 0] = np.asarray(indices.flatten())
    codes = np.empty((len(layout.sizes), n), dtype)
    codes[:] = layout.zero[:, None]
    slot = (layout.code[feature] > 0) & (value != 0)
    codes[layout.column[feature[slot]], rows[slot]] = layout.code[feature[slot]]
    columns = np.unique(layout.column[layout.slots])
    if np.count_nonzero(codes[columns]) != np.count_nonzero(slot):
        raise ValueError("more than one slot of a one-hot column is set")
    number = layout.code[feature] == 0
    rows, feature, value = rows[number], feature[number], value[number]
    for f in layout.numbers:
        here = feature == f
        codes[layout.column[f], rows[here]] = np.searchsorted(layout.thresholds[f], value[here])
    return codes, label * 2 - 1


# --- one tree ------------------------------------------------------------------------


def variance(stats: np.ndarray) -> np.ndarray:
    """Of counts, sums and sums of squares, in Spark's order of operations."""
    count, total, squares = stats
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - (total * total) / count) / count)


@dataclass
class Tree:
    """Nodes in the order they were made; ``left`` is -1 where a node was not split."""

    stats: list[np.ndarray]
    level: list[int]
    split: list[tuple[int, int] | None] = field(default_factory=lambda: [None])
    gain: list[float] = field(default_factory=lambda: [0.0])
    valid: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])

    def add(self, stats: np.ndarray, level: int) -> int:
        self.stats.append(stats)
        self.level.append(level)
        self.split.append(None)
        self.gain.append(0.0)
        self.valid.append(True)
        self.left.append(-1)
        return len(self.left) - 1

    def prediction(self, node: int) -> float:
        count, total, _ = self.stats[node]
        return float(total / count) if count else 0.0

    def router(self, layout: Layout) -> tuple[np.ndarray, np.ndarray, int]:
        """The column a node looks at, and the node that each of its codes leads to."""
        width, n = int(layout.sizes.max()), len(self.left)
        column, to = np.zeros(n, np.int64), np.repeat(np.arange(n, dtype=np.int32)[:, None], width, axis=1)
        for node, left in enumerate(self.left):
            if left >= 0:
                f, cut = self.split[node]
                column[node] = layout.column[f]
                if layout.code[f]:
                    to[node] = left if cut == 0 else left + 1
                    to[node, layout.code[f]] = left + 1 if cut == 0 else left
                else:
                    to[node, : cut + 1], to[node, cut + 1 :] = left, left + 1
        return column, to.ravel(), max(self.level)


def route(codes: np.ndarray, router: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    column, to, depth = router
    n, width = codes.shape[1], len(to) // len(column)
    flat, at, node = codes.reshape(-1), np.arange(n), np.zeros(n, np.int64)
    for _ in range(depth):
        node = to[node * width + flat[column[node] * n + at]].astype(np.int64)
    return node


def histogram(codes, residual, group, groups: int, layout: Layout, in_order: bool) -> np.ndarray:
    """``(3, groups, codes)``: counts, sums and sums of squares. ``in_order`` adds, after them, the sums of the
    rows where a slot is 0, added up row by row as Spark does, which decides between gains that are equal
    but for rounding."""
    keep = np.flatnonzero(group >= 0)
    if len(keep) < len(group):
        codes, residual, group = codes[:, keep], residual[keep], group[keep]
    squares, offsets, slots = residual * residual, layout.offsets, layout.slots
    out = np.zeros((3, groups, offsets[-1] + (len(slots) if in_order else 0)))
    for k, size in enumerate(layout.sizes):
        if size == 1:
            # one value only: nothing to split on
            continue
        place, cells = group * size + codes[k], groups * size
        here = slice(offsets[k], offsets[k + 1])
        out[0, :, here] = np.bincount(place, minlength=cells).reshape(groups, size)
        out[1, :, here] = np.bincount(place, weights=residual, minlength=cells).reshape(groups, size)
        out[2, :, here] = np.bincount(place, weights=squares, minlength=cells).reshape(groups, size)
    if in_order and len(slots):
        # one place more for codes that are no slot
        width = len(slots) + 1
        where = np.full((len(layout.sizes), int(layout.sizes.max())), len(slots))
        where[layout.column[slots], layout.code[slots]] = np.arange(len(slots))
        columns, total = np.unique(layout.column[slots]), np.zeros((2, groups * width))
        for start in range(0, len(group), 10_000):
            rows = slice(start, start + 10_000)
            # what was added up so far comes first, so that sums go on row by row
            place = np.r_[np.arange(groups * width), (group[rows, None] * width + np.arange(width)).ravel()]
            for which, amount in enumerate((residual[rows], squares[rows])):
                laid = np.repeat(amount[:, None], width, axis=1)
                for column in columns:
                    laid[np.arange(len(amount)), where[column, codes[column, rows]]] = 0.0
                total[which] = np.bincount(place, weights=np.r_[total[which], laid.ravel()], minlength=groups * width)
        out[1:, :, offsets[-1] :] = total.reshape(2, groups, width)[:, :, :-1]
    return out


def best_splits(hist, subsets, stats, impurity, least: int, least_gain: float, layout: Layout, root: bool):
    """Per node its best split: feature, cut, gain, and the figures of node, left and right.

    A cut of a number is the last bin that goes left, that of a slot the value that goes left."""
    groups, offsets, slots, features = hist.shape[1], layout.offsets, layout.slots, len(layout.code)
    order = np.full((groups, features), features)
    np.put_along_axis(order, subsets, np.arange(subsets.shape[1])[None, :], axis=1)
    sides = {}
    for f in layout.numbers:
        whole = np.cumsum(hist[:, :, offsets[layout.column[f]] : offsets[layout.column[f] + 1]], axis=2)
        sides[int(f)] = whole[:, :, :-1], whole[:, :, -1:] - whole[:, :, :-1], None
    if len(slots):
        column = layout.column[slots]
        one = hist[:, :, offsets[column] + layout.code[slots]]
        sums = np.stack([hist[:, :, offsets[c] : offsets[c + 1]].sum(axis=2) for c in range(len(layout.sizes))], axis=2)
        none = sums[:, :, column] - one
        if hist.shape[2] > offsets[-1]:
            none[1:] = hist[1:, :, offsets[-1] :]
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = [np.where(s[0] == 0, np.finfo(float).max, s[1] / s[0]) for s in (none, one)]
        zero_left = mean[0] <= mean[1]
        lower = np.where(zero_left, none, one)
        upper = (none + one) - lower
        for i, f in enumerate(slots):
            sides[int(f)] = lower[:, :, i : i + 1], upper[:, :, i : i + 1], np.where(zero_left[:, i], 0, 1)
    usable = np.array(sorted(sides), dtype=np.int64)
    if root and len(usable):
        first = usable[np.argmin(order[0, usable])]
        stats = sides[int(first)][0][:, :, 0] + sides[int(first)][1][:, :, 0]
        impurity = variance(stats)
    gains, cuts = np.full((groups, features), -np.inf), np.zeros((groups, features), np.int64)
    nodes = np.arange(groups)
    for f, (low, high, zero) in sides.items():
        total = low[0] + high[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity[:, None] - low[0] / total * variance(low) - high[0] / total * variance(high)
        gain[(low[0] < least) | (high[0] < least) | ~(gain >= least_gain)] = INVALID
        best = np.argmax(gain, axis=1)
        cuts[:, f] = best if zero is None else zero
        gains[:, f] = np.where(order[:, f] < features, gain[nodes, best], -np.inf)
    top = gains.max(axis=1)
    chosen = np.where(gains == top[:, None], order, features + 1).argmin(axis=1)
    left, right = np.zeros((3, groups)), np.zeros((3, groups))
    for f in np.unique(chosen):
        if int(f) in sides:
            here = np.flatnonzero(chosen == f)
            low, high, zero = sides[int(f)]
            place = cuts[here, f] if zero is None else 0
            left[:, here], right[:, here] = low[:, here, place], high[:, here, place]
    return chosen, cuts[nodes, chosen], top, stats, left, right


@dataclass(frozen=True)
class Settings:
    """What the trees are grown by."""

    trees: int
    depth: int
    least: int
    least_gain: float
    step: float
    share: float
    kept: int
    memory: int
    seed: int
    bins: np.ndarray
    layout: Layout


#: the best splits of a tree's open nodes, by their subsets, figures and impurities, and whether it is the root
Search = Callable[[Tree, list[int], np.ndarray, np.ndarray, np.ndarray, bool], tuple]


def grow(settings: Settings, seed: int, search: Search) -> Tree:
    """One tree, its nodes split in groups that Spark's memory bound allows, drawn in Spark's order."""
    tree, stack, random = Tree([np.zeros(3)], [0]), [0], _JavaRandom(seed)
    features, drawing = len(settings.layout.code), settings.kept < len(settings.layout.code)
    while stack:
        state = random.state
        seeds = [random.next_long() if drawing else 0 for _ in stack]
        subsets = feature_subsets(seeds, features, settings.kept)
        fits = 24 * np.cumsum(settings.bins[subsets].sum(axis=1)) <= settings.memory
        fits[0] = True
        taken = len(fits) if fits.all() else int(np.argmin(fits))
        group, subsets, stack = stack[:taken], subsets[:taken], stack[taken:]
        if stack and drawing:
            # Spark has drawn for the first node that did not fit, and no further
            random.state = state
            for _ in range(taken + 1):
                random.next_long()
        stats = np.array([tree.stats[n] for n in group]).T
        root = group[0] == 0
        found = search(tree, group, subsets, stats, variance(stats), root)
        for i, node in enumerate(group):
            feature, cut, gain, own, left, right = (a[..., i] for a in found)
            if root:
                tree.stats[node] = own
            level = tree.level[node]
            tree.gain[node], tree.valid[node] = float(gain), bool(gain > INVALID)
            if gain <= 0 or level == settings.depth:
                continue
            tree.split[node] = int(feature), int(cut)
            tree.left[node] = tree.add(left, level + 1)
            tree.add(right, level + 1)
            for child, figures in ((tree.left[node], left), (tree.left[node] + 1, right)):
                if level + 1 < settings.depth and abs(float(variance(figures))) >= EPSILON:
                    stack.insert(0, child)
    return tree


def places(tree: Tree, group: list[int]) -> np.ndarray:
    place = np.full(len(tree.left), -1, np.int64)
    place[group] = np.arange(len(group))
    return place


def drawn_rows(block: Block, settings: Settings, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and residuals of the rows that the tree of this number is grown from."""
    part, offset, codes, label, margin = block
    y = label.astype(np.float64)
    residual = y if number == 0 else 4.0 * y / (1.0 + np.exp(np.longdouble(2.0 * y * margin)).astype(np.float64))
    if settings.share >= 1:
        return codes, residual
    u = uniforms(settings.seed + number + part + 1, offset, len(y))
    rows = np.flatnonzero(u < settings.share)
    return codes[:, rows], residual[rows]


def moved_block(block: Block, settings: Settings, router, leaves: np.ndarray, number: int) -> Block:
    """The block with what the tree of this number adds to its rows."""
    part, offset, codes, label, margin = block
    step = 1.0 if number == 0 else settings.step
    return part, offset, codes, label, margin + leaves[route(codes, router)] * step


def leaves_of(tree: Tree) -> np.ndarray:
    return np.array([tree.prediction(n) for n in range(len(tree.left))])


def boost_here(held: list[Block], settings: Settings) -> list[Tree]:
    """All trees in one task, for what is at most one task's rows; sums are Spark's to the last bit."""
    held, trees, layout = sorted(held, key=lambda b: b[:2]), [], settings.layout
    parts = sorted({b[0] for b in held})
    for number in range(settings.trees):
        whole = []
        for part in parts:
            drawn = [drawn_rows(b, settings, number) for b in held if b[0] == part]
            whole.append((np.concatenate([c for c, _ in drawn], axis=1), np.concatenate([r for _, r in drawn])))

        def search(tree, group, subsets, stats, impurity, root):
            router, place, hist = tree.router(layout), places(tree, group), None
            for codes, residual in whole:
                own = histogram(codes, residual, place[route(codes, router)], len(group), layout, True)
                hist = own if hist is None else hist + own
            return best_splits(hist, subsets, stats, impurity, settings.least, settings.least_gain, layout, root)

        tree = grow(settings, settings.seed + number, search)
        trees.append(tree)
        router, leaves = tree.router(layout), leaves_of(tree)
        held = [moved_block(b, settings, router, leaves, number) for b in held]
    return trees
