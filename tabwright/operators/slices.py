"""Order-keeping slices: how ordered work over one column is spread over many tasks.

A running total over all values of a column would need one task for the whole
column. Cut points at the column's approximate quantiles break it in slices of
about equal size; totals run inside a slice, and the totals of the slices before it
are added. The cut points steer the spread only, results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 5_000_000
MAX_SLICES = 4096


def slice_count(rows: int, rows_per_slice: int = ROWS_PER_SLICE) -> int:
    return max(1, min(MAX_SLICES, -(-rows // rows_per_slice)))


def cut_points(
    df: DataFrame, columns: Mapping[str, Column], slices: int | None = None
) -> dict[str, list[float]]:
    """Approximate quantiles of each double-valued expression, at most ``slices - 1``.

    Without ``slices`` a row count decides; tables of one slice need no second look.
    What reaches the driver is one short list per column.
    """
    if slices is None:
        slices = slice_count(df.count())
    if slices <= 1 or not columns:
        return {name: [] for name in columns}
    shares = [i / slices for i in range(1, slices)]
    found = df.agg(
        *[F.percentile_approx(c, shares, 10 * slices).alias(n) for n, c in columns.items()]
    ).first()
    return {name: sorted(set(found[name] or [])) for name in columns}


def add_slices(df: DataFrame, cuts: Mapping[str, Sequence[float]], prefix: str) -> DataFrame:
    """Adds ``{prefix}{column}``, the slice number of each column that has cut points."""
    cut = {c: points for c, points in cuts.items() if points}
    if cut:
        edges = [[float("-inf"), *points, float("inf")] for points in cut.values()]
        df = Bucketizer(
            splitsArray=edges,
            inputCols=list(cut),
            outputCols=[f"{prefix}{c}" for c in cut],
            handleInvalid="keep",
        ).transform(df)
    numbers = {
        f"{prefix}{c}": F.col(f"{prefix}{c}").cast("int") if c in cut else F.lit(0) for c in cuts
    }
    return df.withColumns(numbers) if numbers else df


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str], sliced: bool
) -> DataFrame:
    """Adds ``{s}_before``, the sum of ``s`` over the group's rows before this one, and
    ``{s}_total``, the sum over the whole group.

    ``df`` has a ``slice`` column whose order agrees with ``order``, and no two rows
    of a group share a value of ``order``.
    """
    part = Window.partitionBy(*group, "slice")
    earlier_rows = part.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.select(
        "*",
        *[F.coalesce(F.sum(s).over(earlier_rows), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(s).over(part).alias(f"{s}_total") for s in sums if not sliced],
    )
    if not sliced:
        return out
    # Few rows: one per group and slice.
    per_slice = df.groupBy(*group, "slice").agg(*[F.sum(s).alias(s) for s in sums])
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    earlier_slices = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *group,
        "slice",
        *[F.coalesce(F.sum(s).over(earlier_slices), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    # A left join adds no null filter, so both sides share the shuffled input.
    return out.join(offsets, [*group, "slice"], "left").select(
        *df.columns,
        *[(F.col(f"{s}_before") + F.col(f"{s}_offset")).alias(f"{s}_before") for s in sums],
        *[f"{s}_total" for s in sums],
    )
