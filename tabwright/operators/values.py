"""Value counts of many columns in one pass, and what their order gives: ranks, quantiles.

Repeated values are counted on the map side, so a value that fills a third of a
column still reaches the reducers as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import as_number
from tabwright.operators.slices import add_slices, cut_points, running_totals


def value_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``column, value, n`` of every non-null value of text-like expressions."""
    pairs = [
        F.struct(F.lit(name).alias("column"), c.cast("string").alias("value"))
        for name, c in columns.items()
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


class NumberCounts:
    """Counts of the distinct numbers of several columns, ready for ordered work.

    ``counts`` has ``column, slice, value, n``; ``sliced`` tells whether any column was
    cut in slices.
    """

    def __init__(self, df: DataFrame, columns: Mapping[str, Column], slices: int | None = None):
        numbers = df.select(*[as_number(c).alias(name) for name, c in columns.items()])
        self.columns = list(columns)
        cuts = cut_points(numbers, {c: F.col(c) for c in self.columns}, slices)
        self.sliced = any(cuts.values())
        entries = [
            F.struct(
                F.lit(c).alias("column"), F.col(f"_slice_{c}").alias("slice"), F.col(c).alias("value")
            )
            for c in self.columns
        ]
        self.counts = (
            add_slices(numbers, cuts, "_slice_")
            .select(F.inline(F.array(*entries)))
            .filter(F.col("value").isNotNull())
            .groupBy("column", "slice", "value")
            .agg(F.count("*").alias("n"))
        )

    def quantiles(self, probabilities: Mapping[str, float]) -> DataFrame:
        """Exact quantiles, interpolated between neighbours: one row per column, with
        the number of values (``total``) and of distinct ones (``distinct``)."""
        placed = running_totals(self.counts, ["column"], "value", ["n"], self.sliced)
        first, after = F.col("n_before"), F.col("n_before") + F.col("n")
        total = F.col("n_total")
        picks, results = [F.max("n_total").alias("total"), F.count("*").alias("distinct")], []
        for name, p in probabilities.items():
            for side, nearest in (("lo", F.floor), ("hi", F.ceil)):
                index = nearest(F.lit(float(p)) * (total - 1))
                here = (first <= index) & (index < after)
                picks.append(F.max(F.when(here, F.col("value"))).alias(f"_{name}_{side}"))
            low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
            place = F.lit(float(p)) * (F.col("total") - 1)
            results.append((low + (high - low) * (place - F.floor(place))).alias(name))
        return placed.groupBy("column").agg(*picks).select("column", "total", "distinct", *results)


def rank_table(
    df: DataFrame,
    column: str,
    companions: Sequence[str],
    cuts: Sequence[float],
) -> DataFrame:
    """Average ranks and dense codes of the distinct values of one number column.

    ``rank`` is over all rows that have the value; ``rank1``, ``rank2``, ... are over the
    rows that also have that companion. ``code`` counts the smaller distinct values.
    """
    # helper columns are numbered, so that no name of the table can meet them
    present = [F.count("*"), *[F.count_if(F.col(f"`{c}`").isNotNull()) for c in companions]]
    sliced = add_slices(df.filter(F.col(f"`{column}`").isNotNull()), {column: cuts}, "_slice_")
    counts = (
        sliced.groupBy(F.col(f"`_slice_{column}`").alias("slice"), F.col(f"`{column}`").alias("value"))
        .agg(*[n.alias(f"n{i}") for i, n in enumerate(present)])
        .withColumn("one", F.lit(1).cast("bigint"))
    )
    sums = [f"n{i}" for i in range(len(present))]
    placed = running_totals(counts, [], "value", [*sums, "one"], bool(cuts))

    def average(i: int) -> Column:
        return F.col(f"n{i}_before") + (F.col(f"n{i}") + 1) / 2

    return placed.select(
        "value",
        "slice",
        average(0).alias("rank"),
        *[average(i).alias(f"rank{i}") for i in range(1, len(present))],
        F.col("one_before").alias("code"),
    )
