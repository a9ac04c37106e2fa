"""Binned columns and the contingency counts of all column pairs in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions import as_number, blocks, col_of

# Sent along with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(blocks)


def equal_width_bins(
    df: DataFrame, columns: Sequence[str], bins: int, beside: Sequence[Column] = ()
) -> DataFrame:
    """The bin of each number as columns ``b0, b1, ...`` in the order of ``columns``.

    Bins are 0 to ``bins - 1`` over the range of the finite values, null if missing; an
    infinite value is counted apart, in bin -1 or ``bins``. ``beside`` names columns to keep. The ranges come from one
    aggregate row, read back as a scalar subquery. A constant column falls in bin 0.
    """
    numbers = [as_number(col_of(c)) for c in columns]
    ends = []
    for i, x in enumerate(numbers):
        finite = F.when(F.abs(x) < float("inf"), x)
        ends += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
    ranges = df.agg(F.struct(*ends).alias("range")).scalar()
    taken = df.select(*[x.alias(f"x{i}") for i, x in enumerate(numbers)], *beside).withColumn("range", ranges)
    made = []
    for i in range(len(columns)):
        x, lo, hi = F.col(f"x{i}"), F.col(f"range.lo{i}"), F.col(f"range.hi{i}")
        place = F.try_divide((x - lo) * F.lit(float(bins)), hi - lo)
        inside = F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(bins - 1)).cast("int")
        outside = F.when(x == float("inf"), bins).when(x == float("-inf"), -1)
        made.append(F.when(x.isNotNull(), F.coalesce(outside, inside)).alias(f"b{i}"))
    return taken.select(*made, *taken.columns[len(columns) : -1])


def equal_width_bins_beside(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int
) -> DataFrame:
    """Bins of the number columns, then the category columns as they are: ``b0, b1, ...``."""
    if not numeric:
        return df.select(*[col_of(c).alias(f"b{i}") for i, c in enumerate(categorical)])
    beside = [col_of(c).alias(f"b{i}") for i, c in enumerate(categorical, len(numeric))]
    return equal_width_bins(df, numeric, bins, beside)


def constants(values: Sequence[object]) -> Column:
    """A constant array."""
    return F.array(*[F.lit(v) for v in values])


def pair_name(names: Sequence[tuple[str, str]], side: int) -> Column:
    """The left (0) or right (1) column name of the row's ``pair`` number."""
    return F.get(constants([p[side] for p in names]), F.col("pair"))


def all_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


def pair_rows(
    df: DataFrame, columns: Mapping[str, Column], pairs: Sequence[tuple[str, str]], *keep: str
) -> DataFrame:
    """``pair, x, y`` for every row and pair where both columns are present.

    The columns become one array per row and a pair picks two of its places. All have
    one type. ``keep`` names columns of ``df`` to carry along.
    """
    place = {name: i for i, name in enumerate(columns)}
    left, right = ([place[p[side]] for p in pairs] for side in (0, 1))
    pair = F.col("pair")
    return (
        df.select(*keep, F.array(*columns.values()).alias("_row"))
        .select(*keep, "_row", F.explode(constants(range(len(pairs)))).alias("pair"))
        .select(
            *keep,
            "pair",
            F.get("_row", F.get(constants(left), pair)).alias("x"),
            F.get("_row", F.get(constants(right), pair)).alias("y"),
        )
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    )


def pair_counts(
    df: DataFrame, levels: Mapping[str, Column], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """``pair, x, y, n``: the non-empty cells of each pair of columns.

    Every row meets every pair once, in blocks of rows that are counted before the shuffle.
    """
    place = {name: i for i, name in enumerate(levels)}
    sides = [(place[a], place[b]) for a, b in pairs]
    texts = df.select(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(levels.values())])

    def count(batches):
        for block in blocks.gather(batches):
            yield from blocks.cells(block, sides)

    counted = texts.mapInArrow(count, "pair int, x string, y string, n bigint")
    return counted.groupBy("pair", "x", "y").agg(F.sum("n").alias("n"))


def pair_moments(
    df: DataFrame, columns: Mapping[str, Column], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """``pair, n, xx, yy, xy``: rows where both numbers of a pair are present, and the sums of
    squares and products about the means of these rows.

    Blocks of rows are summed up about their own means, which are then moved to the common one.
    """
    place = {name: i for i, name in enumerate(columns)}
    sides = [(place[a], place[b]) for a, b in pairs]
    numbers = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())])

    def sums(batches):
        for block in blocks.gather(batches):
            yield blocks.moments(block, sides)

    schema = "pair int, n bigint, x double, y double, xx double, yy double, xy double"
    # one row per block and pair; means are taken above the least one, so that equal ones stay equal
    parts, all_of = numbers.mapInArrow(sums, schema), Window.partitionBy("pair")
    n, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    low = parts.select("*", *[(F.col(c) - F.min(c).over(all_of)).alias(f"a{c}") for c in ("x", "y")])
    moved = low.select(
        "*",
        *[
            (F.col(f"a{c}") - F.sum(F.col(f"a{c}") * n).over(all_of) / F.sum(n).over(all_of)).alias(f"d{c}")
            for c in ("x", "y")
        ],
    )
    return moved.groupBy("pair").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("xx") + n * dx * dx).alias("xx"),
        F.sum(F.col("yy") + n * dy * dy).alias("yy"),
        F.sum(F.col("xy") + n * dx * dy).alias("xy"),
    )
