"""Correlations of all column pairs, computed where the rows are.

Each function gives ``left_col, right_col`` and one figure per pair of columns.
Pearson, Spearman and Kendall use the rows where both columns of the pair are present.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions import as_number, bivariate, col_of, concordance, is_missing
from tabwright.operators.pairs import (
    all_pairs,
    constants,
    equal_width_bins_beside,
    pair_counts,
    pair_moments,
    pair_name,
    pair_rows,
)
from tabwright.operators.slices import add_slices, cut_points, slice_count
from tabwright.operators.values import NumberCounts, rank_table
from tabwright.sources.tables import stage

# Sent along with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(bivariate)
cloudpickle.register_pickle_by_value(concordance)

BINS = 10
#: Rows of a slice of Kendall; and as slices are counted against slices, no more of them.
ROWS_PER_KENDALL_SLICE, MOST_KENDALL_SLICES = 250_000, 256


def _no_pairs(df: DataFrame, name: str) -> DataFrame:
    schema = f"left_col string, right_col string, {name} double"
    return df.sparkSession.createDataFrame([], schema)


def _corr_table(
    df: DataFrame, columns: Mapping[str, Column], sides: Sequence[tuple[str, str]], pairs: Sequence[tuple[str, str]], name: str
) -> DataFrame:
    """Pearson of two of the ``columns`` per pair; null when either does not vary.

    ``sides`` tells which columns stand for the pairs that the rows are named by.
    """
    spread = F.sqrt("xx") * F.sqrt("yy")
    found = pair_moments(df, columns, sides).select("pair", F.try_divide(F.col("xy"), spread).alias(name))
    return _named(df, pairs, found, name)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = all_pairs(columns)
    if not pairs:
        return _no_pairs(df, "pearson")
    return _corr_table(df, {c: as_number(col_of(c)) for c in columns}, pairs, pairs, "pearson")


def missing_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson of the columns' missing flags; null where a column is never or always there.

    Rows are counted by their pattern of missing columns first; the pairs are taken
    from the patterns.
    """
    if len(columns) < 2:
        return _no_pairs(df, "missing_corr")
    flags = [is_missing(df, c).cast("int").alias(f"c{i}") for i, c in enumerate(columns)]
    patterns = df.groupBy(*flags).agg(F.count("*").alias("_n"))
    pairs = all_pairs(columns)
    marks = pair_rows(patterns, {c: F.col(f"c{i}") for i, c in enumerate(columns)}, pairs, "_n")
    n, x, y, both = (F.col(c).cast("double") for c in ("n", "nx", "ny", "nxy"))
    spread = F.sqrt(n * x - x * x) * F.sqrt(n * y - y * y)
    found = (
        marks.groupBy("pair")
        .agg(
            F.sum("_n").alias("n"),
            F.sum(F.col("_n") * F.col("x")).alias("nx"),
            F.sum(F.col("_n") * F.col("y")).alias("ny"),
            F.sum(F.col("_n") * F.col("x") * F.col("y")).alias("nxy"),
        )
        .select("pair", F.try_divide(n * both - x * y, spread).alias("missing_corr"))
    )
    return _named(df, pairs, found, "missing_corr")


def _numbers_with_cuts(
    df: DataFrame, columns: Sequence[str], slices: int | None
) -> tuple[DataFrame, dict[str, list[float]]]:
    """The columns as numbers ``c0, c1, ...``, and their cut points."""
    names = [f"c{i}" for i in range(len(columns))]
    numbers = df.select(*[as_number(col_of(c)).alias(n) for c, n in zip(columns, names)])
    return numbers, cut_points(numbers, {n: F.col(n) for n in names}, slices)


def _gap_patterns(numbers: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """For each column with missing values the first column missing on the same rows.

    One row per column pair comes to the driver.
    """
    flags = [F.col(c).isNull().alias(c) for c in columns]
    patterns = numbers.groupBy(*flags).agg(F.count("*").alias("_n"))
    pairs = all_pairs(columns)
    found = (
        pair_rows(patterns, {c: F.col(c) for c in columns}, pairs)
        .groupBy("pair")
        .agg(
            F.bool_or("x").alias("left"),
            F.bool_or("y").alias("right"),
            F.bool_and(F.col("x") == F.col("y")).alias("same"),
        )
        .collect()
    )
    first: dict[str, str | None] = dict.fromkeys(columns)
    for row in sorted(found, key=lambda r: r["pair"]):
        a, b = pairs[row["pair"]]
        if row["left"]:
            first[a] = first[a] or a
        if row["right"]:
            first[b] = first[b] or (first[a] if row["same"] else None)
    for row in found:
        b = pairs[row["pair"]][1]
        if row["right"] and first[b] is None:
            first[b] = b
    return first


def spearman(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """Pearson of average ranks; every pair is ranked over its own complete rows.

    A column gets one rank per pattern of gaps among the other columns. Only distinct values are ranked, and the ranks are joined back by value: once per
    column, broadcast by Spark where the values are few, otherwise a join that
    adaptive execution splits at frequent values.
    """
    if len(columns) < 2:
        return _no_pairs(df, "spearman")
    own = all_pairs(columns)
    numbers, cuts = _numbers_with_cuts(df, columns, slices)
    columns = numbers.columns
    gaps = _gap_patterns(numbers, columns)
    ranked, rank_of = numbers, {}
    for c in columns:
        companions = sorted({g for g in gaps.values() if g and g != gaps[c]})
        names = {None: f"_rank_{c}", **{g: f"_rank_{c}_{g}" for g in companions}}
        table = rank_table(numbers, c, companions, cuts[c]).select(
            F.col("value").alias(f"_value_{c}"),
            F.col("rank").alias(names[None]),
            *[F.col(f"rank{i}").alias(names[g]) for i, g in enumerate(companions, 1)],
        )
        ranked = ranked.join(table, F.col(c) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
        rank_of |= {(c, o): names.get(gaps[o], names[None]) for o in columns}
    pairs = all_pairs(columns)
    sides = [(rank_of[a, b], rank_of[b, a]) for a, b in pairs]
    every = dict.fromkeys(name for side in sides for name in side)
    return _corr_table(ranked, {name: F.col(name) for name in every}, sides, own, "spearman")


def kendall_binned(df: DataFrame, columns: Sequence[str], bins: int = 32) -> DataFrame:
    """Kendall tau-b of every column pair over quantile bins, with the flag ``binned``.

    Values between the same two of a column's quantiles count as equal, which is tau-b of the
    binned columns, exactly. One pass over the rows counts the cells of all pairs, at most ``bins`` squared
    each; running totals over a pair's grid tell how many rows lie below and to the left of each cell.
    """
    if len(columns) < 2:
        return _no_pairs(df, "kendall").withColumn("binned", F.lit(True))
    pairs = all_pairs(columns)
    numbers = df.select(*[as_number(col_of(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    names = {f"q{k}": k / bins for k in range(1, bins)}
    found = NumberCounts(numbers, {c: F.col(c) for c in numbers.columns}).quantiles(names)
    # bins - 1 numbers per column
    cuts = {r["column"]: sorted({r[q] for q in names}) for r in found.collect()}

    def code(c: str) -> Column:
        points = constants([float(x) for x in cuts.get(c, [])])
        above = F.aggregate(points, F.lit(0), lambda n, x: n + (F.col(c) > x).cast("int"))
        return F.when(F.col(c).isNotNull(), above)

    coded = numbers.select(*[code(c).alias(c) for c in numbers.columns])
    cells = pair_rows(coded, {c: F.col(c) for c in coded.columns}, all_pairs(coded.columns))
    cells = cells.groupBy("pair", "x", "y").agg(F.count("*").alias("n"))

    def tau(cell: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros((bins, bins))
        grid[cell["x"], cell["y"]] = cell["n"]
        s = concordance.grid_balance(grid)
        n, r, c = grid.sum(), grid.sum(1), grid.sum(0)
        every, ties_x, ties_y = n * (n - 1) / 2, (r * (r - 1) / 2).sum(), (c * (c - 1) / 2).sum()
        spread = np.sqrt(every - ties_x) * np.sqrt(every - ties_y)
        value = s / spread if spread else None
        return pd.DataFrame({"pair": [int(cell["pair"].iloc[0])], "kendall": [value]})

    taus = cells.groupBy("pair").applyInPandas(tau, "pair int, kendall double")
    return _named(df, pairs, taus, "kendall").withColumn("binned", F.lit(True))


def kendall(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """Exact Kendall tau-b of every column pair, without comparing rows with rows.

    Every column is cut in slices at quantiles, at least ``slices``; a cut point is a slice of its own, as one
    value may fill many rows. Two rows that differ in the slices of both columns of a pair are settled by the
    counts of these. Rows of one slice meet in one task per column, with all their values: in the first
    column's task the pair is settled by the values of both, in the second's by its values and the first's
    slices, so that no two rows are counted twice. A slice of one value settles nothing and is not sent.
    Every row is so sent at most once per column, and the work is rows x columns^2 x log(rows of a slice).
    """
    if len(columns) < 2:
        return _no_pairs(df, "kendall")
    slices = max(slices or 1, min(MOST_KENDALL_SLICES, slice_count(df.count(), ROWS_PER_KENDALL_SLICE)))
    own = all_pairs(columns)
    numbers, cuts = _numbers_with_cuts(df, columns, slices)
    columns = numbers.columns
    pairs = all_pairs(columns)
    pair_of = {(columns.index(a), columns.index(b)): i for i, (a, b) in enumerate(pairs)}
    edges = [np.array(cuts[c]) for c in columns]

    def code(c: str) -> Column:
        """Odd for a cut point, even between two."""
        if not cuts[c]:
            return F.when(F.col(c).isNotNull(), 0)
        low = F.get(constants([float(x) for x in cuts[c]]), F.col(f"_slice_{c}") - 1)
        at = F.when(low == F.col(c), 1).otherwise(0)
        return F.when(F.col(c).isNotNull(), 2 * F.col(f"_slice_{c}") - at)

    sliced = add_slices(numbers, {c: cuts[c] for c in columns}, "_slice_")
    coded = sliced.select(*columns, *[code(c).cast("int").alias(f"_code_{c}") for c in columns])
    cells = pair_rows(coded, {c: F.col(f"_code_{c}") for c in columns}, pairs)
    cells = cells.groupBy("pair", "x", "y").agg(F.count("*").alias("n"))

    def between(cell: pd.DataFrame) -> pd.DataFrame:
        x, y = cell["x"].to_numpy(), cell["y"].to_numpy()
        grid = np.zeros((x.max() + 1, y.max() + 1))
        grid[x, y] = cell["n"]
        r, c = grid.sum(1)[1::2], grid.sum(0)[1::2]
        ties = (r * (r - 1) / 2).sum(), (c * (c - 1) / 2).sum()
        found = (int(cell["pair"].iloc[0]), concordance.grid_balance(grid), *map(float, ties), float(grid.sum()))
        return pd.DataFrame([found], columns=["pair", "s", "ties_x", "ties_y", "n"])

    def inside(table: pa.Table) -> pa.Table:
        here = table.column("place")[0].as_py()
        flat = pc.list_flatten(table.column("row")).to_numpy()
        rows = flat.reshape(len(table), len(edges))
        x, xs = concordance.ranked(rows[:, here])
        out = []
        for other, cut in enumerate(edges):
            if other == here:
                continue
            y = rows[:, other]
            there = ~np.isnan(y)
            if other < here:
                y = y[there]
                y, ys = np.searchsorted(cut, y, "left") + np.searchsorted(cut, y, "right"), 2 * len(cut) + 1
            else:
                y, ys = concordance.ranked(y[there])
            s, tied = concordance.balance(x[there], y, xs, ys)
            first = here < other
            out.append((pair_of[min(here, other), max(here, other)], s, tied if first else 0, 0 if first else tied, 0))
        names = ["pair", "s", "ties_x", "ties_y", "n"]
        return pa.table({k: pa.array(v, pa.int32() if k == "pair" else pa.float64()) for k, v in zip(names, zip(*out))})

    schema = "pair int, s double, ties_x double, ties_y double, n double"
    entries = [
        F.when(
            F.col(f"_code_{c}") % 2 == 0,
            F.struct(F.lit(i).alias("place"), F.col(f"_code_{c}").alias("slice")),
        )
        for i, c in enumerate(columns)
    ]
    # missing values as NaN; no present one is
    row = F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in columns]).alias("row")
    sent = coded.select(row, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("to"))
    groups = len(columns) * max(len(cut) + 1 for cut in edges)
    sent = sent.select("to.place", "to.slice", "row").repartition(groups, "place", "slice")
    settled = sent.groupBy("place", "slice").applyInArrow(inside, schema)
    found = cells.groupBy("pair").applyInPandas(between, schema).unionByName(settled)
    found = found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("s", "ties_x", "ties_y", "n")])
    every = F.col("n") * (F.col("n") - 1) / 2
    spread = F.sqrt(every - F.col("ties_x")) * F.sqrt(every - F.col("ties_y"))
    found = found.select("pair", F.try_divide(F.col("s"), spread).alias("kendall"))
    return _named(df, own, found, "kendall")


def _named(df: DataFrame, pairs: Sequence[tuple[str, str]], found: DataFrame, name: str) -> DataFrame:
    """One row for every pair, also for those that no row fills."""
    numbers = df.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("pair"))
    return numbers.join(found, "pair", "left").select(
        pair_name(pairs, 0).alias("left_col"), pair_name(pairs, 1).alias("right_col"), name
    )


def _binned(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int):
    """The columns as levels ``b0, b1, ...``: numbers in equal-width bins, the others as they are."""
    spans = equal_width_bins_beside(df, numeric, categorical, bins)
    return spans, {c: F.col(f"b{i}") for i, c in enumerate([*numeric, *categorical])}


def cramers_v(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str] = (),
    bins: int = BINS,
    bias_correction: bool = False,
    pairs: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Cramér's V of column pairs; null where a column of the pair has one level.

    Chi-square over all cells, the empty ones included, follows from the non-empty
    ones: the sum of o^2 / (row x column total), less 1, times n.
    """
    pairs = list(pairs) if pairs is not None else all_pairs([*numeric, *categorical])
    if not pairs:
        return _no_pairs(df, "cramers_v")
    binned, levels = _binned(df, numeric, categorical, bins)
    found = _table_figures(stage(pair_counts(binned, levels, pairs), "pair-cells"))
    phi2 = F.greatest(F.col("share") - 1, F.lit(0.0))
    r, c, n = (F.col(k).cast("double") for k in ("r", "c", "n"))
    if bias_correction:
        phi2 = F.greatest(phi2 - F.try_divide((r - 1) * (c - 1), n - 1), F.lit(0.0))
        r, c = r - F.try_divide((r - 1) ** 2, n - 1), c - F.try_divide((c - 1) ** 2, n - 1)
    v = F.sqrt(F.try_divide(phi2, F.least(r, c) - 1))
    return _named(df, pairs, found.select("pair", v.alias("cramers_v")), "cramers_v")


def contingency(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = BINS
) -> DataFrame:
    """``n, chi2, r, c`` of the contingency table of every pair: rows, chi-square, and levels."""
    pairs = all_pairs([*numeric, *categorical])
    binned, levels = _binned(df, numeric, categorical, bins)
    found = _table_figures(stage(pair_counts(binned, levels, pairs), "pair-cells"))
    chi2 = F.greatest((F.col("share") - 1) * F.col("n"), F.lit(0.0)).alias("chi2")
    out = _named(df, pairs, found.select("pair", F.struct("n", chi2, "r", "c").alias("f")), "f")
    return out.select("left_col", "right_col", "f.n", "f.chi2", "f.r", "f.c")


def _table_figures(cells: DataFrame) -> DataFrame:
    """``pair, share, n, r, c`` from cells: the sum of o^2 / (row x column total), and sizes.

    Cells are read several times and should be stored."""
    rows = cells.groupBy("pair", "x").agg(F.sum("n").alias("in_row"))
    columns = cells.groupBy("pair", "y").agg(F.sum("n").alias("in_column"))
    o, r, c = (F.col(k).cast("double") for k in ("n", "in_row", "in_column"))
    joint = (
        cells.join(rows, ["pair", "x"])
        .join(columns, ["pair", "y"])
        .groupBy("pair")
        .agg(F.sum(o * o / (r * c)).alias("share"), F.sum("n").alias("n"))
    )
    # Counting the totals, not rows, keeps the same shuffled tables in use.
    heights = rows.groupBy("pair").agg(F.count("in_row").alias("r"))
    widths = columns.groupBy("pair").agg(F.count("in_column").alias("c"))
    return joint.join(heights, "pair").join(widths, "pair")


def auto_correlation(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = BINS,
    slices: int | None = None,
) -> DataFrame:
    """Spearman for two number columns, Cramér's V (numbers binned) for other pairs."""
    other = [p for p in all_pairs([*numeric, *categorical]) if p[1] in set(categorical)]
    ranked = spearman(df, numeric, slices).select(
        "left_col", "right_col", F.lit("spearman").alias("method"), F.col("spearman").alias("value")
    )
    crossed = cramers_v(df, categorical, numeric, bins, pairs=other).select(
        "left_col", "right_col", F.lit("cramers").alias("method"), F.col("cramers_v").alias("value")
    )
    return ranked.unionByName(crossed)


def _levels(cells: DataFrame, side: str, block: int) -> DataFrame:
    """``pair, block, spans``: for each level, in order, where its share begins and ends.

    Levels are ordered as numbers where they are bins, else as text. A block holds at
    most ``block`` of them.
    """
    order = Window.partitionBy("pair").orderBy(F.expr(f"try_cast({side} as int)"), side)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    totals = cells.groupBy("pair", side).agg(F.sum("n").alias("n"))
    end = F.sum("n").over(upto) / F.sum("n").over(Window.partitionBy("pair"))
    begin = (F.sum("n").over(upto) - F.col("n")) / F.sum("n").over(Window.partitionBy("pair"))
    placed = totals.select("pair", F.row_number().over(order).alias("k"), begin.alias("begin"), end.alias("end"))
    return placed.groupBy("pair", F.expr(f"(k - 1) div {block}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("k", "begin", "end"))).alias(f"{side}_spans")
    )


def _pooled(cells: DataFrame, numbers: dict[int, tuple[bool, bool]]) -> DataFrame:
    """Cells whose bins of numbers are joined with their neighbours up to ``sqrt(n)`` rows.

    An almost empty cell of two rare bins weighs more than all others together. ``numbers`` says
    per pair which of its sides are bins; levels of a category have no neighbours and stay.
    """
    for side, at in (("x", 0), ("y", 1)):
        binned = [pair for pair, sides in numbers.items() if sides[at]]
        if not binned:
            continue
        totals = cells.where(F.col("pair").isin(binned)).groupBy("pair", side).agg(F.sum("n").alias("n"))
        # a column's bins are few
        rows = totals.groupBy("pair").agg(
            F.sort_array(F.collect_list(F.struct(F.col(side).cast("int").alias("k"), "n", side))).alias("bins")
        )

        def pool(batches, side=side):
            for batch in batches:
                out = []
                for pair, bins in zip(batch["pair"], batch["bins"]):
                    counts = np.array([b["n"] for b in bins])
                    least, group, held, left = np.sqrt(counts.sum()), 0, 0, counts.sum()
                    for b, n in zip(bins, counts):
                        out.append((pair, b[side], f"{group}"))
                        held, left = held + n, left - n
                        if held >= least and left >= least:
                            group, held = group + 1, 0
                yield pd.DataFrame(out, columns=["pair", side, "pool"])

        pools = rows.mapInPandas(pool, f"pair int, {side} string, pool string")
        joined = cells.join(pools, ["pair", side], "left").withColumn(side, F.coalesce("pool", side))
        cells = joined.groupBy("pair", "x", "y").agg(F.sum("n").alias("n"))
    return cells


def _normal_sums(cells: DataFrame, block: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per pair what the levels of either column add to a bivariate normal's chi-square.

    Levels are added, never multiplied: a column is one array, however many levels it has.
    """

    def add(batches):
        sums: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            for pair, side, spans in zip(batch["pair"], batch["side"], batch["spans"]):
                at = np.array([(s["begin"], s["end"]) for s in spans])
                sums[pair, side] = sums.get((pair, side), 0) + bivariate.level_sums(at)
        rows = [(*key, s) for key, s in sums.items()]
        yield pd.DataFrame(rows, columns=["pair", "side", "s"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        # one row per task
        return parts[:1].assign(s=[np.sum(np.stack(parts["s"].to_list()), axis=0)])

    sides = [
        _levels(cells, side, block).select("pair", F.lit(side).alias("side"), F.col(f"{side}_spans").alias("spans"))
        for side in ("x", "y")
    ]
    schema = "pair int, side string, s array<double>"
    parts = sides[0].unionByName(sides[1]).mapInPandas(add, schema)
    whole = parts.groupBy("pair", "side").applyInPandas(total, schema).toArrow()
    found = {
        (r, side): np.asarray(s)
        for r, side, s in zip(
            whole.column("pair").to_pylist(),
            whole.column("side").to_pylist(),
            (v.values.to_numpy() for v in whole.column("s")),
        )
    }
    return {pair: (s, found[pair, "y"]) for (pair, side), s in found.items() if side == "x"}


def _highest_sums(cells: DataFrame) -> dict[int, tuple[float, float]]:
    """Per pair the same sums at correlation 1, where both columns rise together: cells are the
    overlaps of the levels' shares."""
    order = Window.partitionBy("pair").orderBy(F.expr("try_cast(level as int)"), "level")
    marks = None
    for side in ("x", "y"):
        totals = cells.groupBy("pair", F.col(side).alias("level")).agg(F.sum("n").alias("n"))
        begin = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
        own = totals.select("pair", begin.alias("at"), F.col("n").alias(f"n_{side}"))
        marks = own if marks is None else marks.unionByName(own, allowMissingColumns=True)
    # both columns' levels begin at most once at each place
    marks = marks.groupBy("pair", "at").agg(F.max("n_x").alias("n_x"), F.max("n_y").alias("n_y"))
    along = Window.partitionBy("pair").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    total = cells.groupBy("pair").agg(F.sum("n").alias("n"))
    steps = marks.join(total, "pair").select(
        "pair",
        F.col("n").cast("double").alias("n"),
        (F.lead("at").over(along) - F.col("at")).alias("more"),
        (F.col("n") - F.col("at")).alias("rest"),
        F.last("n_x", True).over(upto).cast("double").alias("x"),
        F.last("n_y", True).over(upto).cast("double").alias("y"),
    )
    o = F.coalesce("more", "rest").cast("double")
    sums = steps.groupBy("pair").agg(
        F.sum(o * o / (F.col("x") * F.col("y"))).alias("squares"),
        F.sum(F.col("n") * o / (F.col("x") * F.col("y"))).alias("singles"),
    )
    return {r["pair"]: (r["squares"], r["singles"]) for r in sums.collect()}


def phi_k(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = BINS,
    block: int = 256,
) -> DataFrame:
    """phi_k of column pairs: the correlation of a bivariate normal whose cells, with the same
    marginal shares, are as far from independence as the table's.

    A table of ``n`` rows drawn from a normal has on average a chi-square above the normal's own, by the
    noise of its cells: the degrees of freedom at correlation 0, more where cells are sparse. That
    pedestal is taken from the same normal, and sparse bins of numbers are joined with their
    neighbours, so figures agree between numbers of bins. The published definition takes the degrees of
    freedom everywhere and stretches the upper end to the greatest chi-square a table of that size can
    have; both make figures depend on the bins and are left out. A pair below the
    pedestal has 0; one with a single row or column, or whose pedestal leaves no room, has null.

    The normal is expanded in Hermite functions, in which the levels of both columns separate: work
    and memory grow with levels, not with levels by levels, in blocks of ``block``. Above
    ``bivariate.HIGHEST`` figures are interpolated up to correlation 1, which is exact.
    """
    pairs = all_pairs([*numeric, *categorical])
    if not pairs:
        return _no_pairs(df, "phi_k")
    binned, levels = _binned(df, numeric, categorical, bins)
    numbers = set(numeric)
    sides = {k: (a in numbers, b in numbers) for k, (a, b) in enumerate(pairs)}
    cells = stage(_pooled(stage(pair_counts(binned, levels, pairs), "pair-cells"), sides), "phi-k-cells")
    # one row per pair
    figures = {r["pair"]: r for r in _table_figures(cells).collect()}
    wide = {pair for pair, f in figures.items() if min(f["r"], f["c"]) >= 2}
    found: dict[int, float | None] = {pair: None for pair in figures if pair not in wide}
    if wide:
        kept = cells.where(F.col("pair").isin(list(wide)))
        sums, highest = _normal_sums(kept, block), _highest_sums(kept)
        found |= {pair: _correlation(figures[pair], *sums[pair], *highest[pair]) for pair in wide}
    rows = df.sparkSession.createDataFrame(list(found.items()), "pair int, phi_k double")
    return _named(df, pairs, rows, "phi_k")


def _correlation(figures, x: np.ndarray, y: np.ndarray, squares: float, singles: float) -> float | None:
    """The correlation at which a normal is expected to give a table's sum of o^2 / (row x column total)."""
    n, r, c = (float(figures[k]) for k in ("n", "r", "c"))
    if (r - 1) * (c - 1) / n >= squares - 1:
        return None
    rhos = np.linspace(0, bivariate.HIGHEST, 971)
    two, one = bivariate.expected_sums(x, y, rhos)
    two, one = np.append(two, squares), np.append(one, singles)
    values = np.maximum.accumulate(two * (1 - 1 / n) + (one - r - c + 1) / n)
    share = figures["share"]
    if share <= values[0]:
        return 0.0
    # a table of a function of the other column has no noise
    if share >= min(values[-1], squares):
        return 1.0
    return float(np.interp(share, values, np.append(rhos, 1.0)))
